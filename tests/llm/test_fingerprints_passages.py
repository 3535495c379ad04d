import hashlib
from collections import Counter

import numpy as np
import pytest
from conftest_llm import prose

from recordflow.llm import prefixhash, recompress


def plain_extension(a, i, b, j):
    n = 0
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    return n


def test_spans_and_extensions():
    a, b = "the cat sat on the mat — 漢字🙂 the cat", "a cat sat on the mat — 漢字! the cats"
    x, y = prefixhash.Prefixes(a), prefixhash.Prefixes(b)
    for i in range(0, len(a), 3):
        for j in range(0, len(b), 2):
            assert prefixhash.longest_common_extension(x, i, y, j) == plain_extension(a, i, b, j)
    assert prefixhash.span_equal(x, 4, y, 2, 10) and not prefixhash.span_equal(x, 3, y, 2, 10)
    assert prefixhash.Prefixes("").span(0, 0) == (0, 0)


def test_spans_over_blocks(monkeypatch):
    text = prose(300)
    whole = prefixhash.Prefixes(text)
    spans = whole.spans(12)
    monkeypatch.setattr(prefixhash, "BLOCK", 64)
    monkeypatch.setattr(prefixhash, "_made", {})
    cut = prefixhash.Prefixes(text)
    assert all((p == q).all() for p, q in zip(whole.arrays, cut.arrays))
    assert (cut.spans(12) == spans).all() and len(spans) == len(text) - 11


def plain_print(text, width=12, kept=64):
    """Length, hash and least span hashes of a text, a span at a time."""
    marked = prefixhash.MARK * (width - 1) + text + prefixhash.MARK * (width - 1)

    def hashed(span):
        return [sum((ord(c) + 1) * pow(b, i, prefixhash.P) for i, c in enumerate(span)) % prefixhash.P for b in prefixhash.BASES]

    both = [hashed(marked[i : i + width]) for i in range(len(text) + width - 1)]
    values = {int(prefixhash.mixed(np.array([x << 31 | y], np.uint64))[0]) for x, y in both}
    return f"{len(text):x}.{hashed(text)[0]:08x}{hashed(text)[1]:08x}." + "".join(f"{v:08x}" for v in sorted(values)[:kept])


def printed(text):
    return prefixhash.prints([text])[0][0]


@pytest.mark.parametrize("block", [1 << 16, 64])
def test_fingerprints_of_texts_end_to_end(monkeypatch, block):
    monkeypatch.setattr(prefixhash, "BLOCK", block)
    monkeypatch.setattr(prefixhash, "_made", {})
    texts = [prose(80), "", "ab", "short one", prose(7, 3), "é" * 40, "", prose(300, 9), "x" * 900, "\0", "漢🙂"]
    found, laid = prefixhash.prints(texts)
    assert found == [plain_print(t) for t in texts]
    one, other = np.array([0, 4, 5, 1, 7, 0]), np.array([7, 0, 5, 2, 0, 3])
    assert laid.common_starts(one, other).tolist() == [plain_extension(texts[i], 0, texts[j], 0) for i, j in zip(one, other)]


def test_fingerprints_of_odd_rows(clashing):
    found = prefixhash.fingerprints(clashing).collect()
    rows = [(r.doc_id, r.text or "") for r in clashing.collect()]
    assert Counter((r.doc_id, r.n_chars) for r in found) == Counter((i, len(t)) for i, t in rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    unique = [i for i, n in Counter(i for i, _ in rows).items() if n == 1]
    by_id, order = {r.doc_id: r for r in found}, sorted(unique, reverse=True)
    text = dict(rows)
    for i, after in ((9, 8), (8, 7), (7, 6), (6, 5), (5, 4), (4, 3)):
        half = len(text[i]) // 2
        edited = text[i][: len(text[i]) - half] + text[after][:half]
        assert by_id[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_id[i].common_next == plain_extension(text[i], 0, text[after], 0)
    assert order[0] == 9
    assert by_id[7].near_next == 1.0 and by_id[6].fingerprint == by_id[7].fingerprint
    assert 0.95 < by_id[7].near_edited < 1.0 and by_id[5].near_edited > 0


def test_order_over_many_ranges(documents):
    rows = [(i * 7 % 501, f"text number {i} " + prose(i % 40, i)) for i in range(501)]
    old = prefixhash.RANGE_BYTES
    try:
        prefixhash.RANGE_BYTES = 500
        found = {r.doc_id: r for r in prefixhash.fingerprints(documents(*rows)).collect()}
    finally:
        prefixhash.RANGE_BYTES = old
    text = dict(rows)
    for i in range(501):
        after = text[(i - 1) % 501]
        half = len(text[i]) // 2
        assert found[i].edited_sha256 == hashlib.sha256((text[i][: len(text[i]) - half] + after[:half]).encode()).hexdigest()


def test_fingerprints_of_one_and_none(documents):
    (one,) = prefixhash.fingerprints(documents((None, "only this"))).collect()
    assert one.doc_id is None and one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"only only").hexdigest()
    assert prefixhash.fingerprints(documents()).collect() == []


def test_likeness_follows_the_share():
    a, b = prose(400), prose(400, 501)
    mixed = a[: len(a) // 2] + b[: len(a) // 2]
    found = prefixhash.prints([a, mixed, b])[0]
    assert 0.25 < prefixhash.likeness(found[0], found[1]) < 0.8
    assert prefixhash.likeness(found[0], found[2]) < 0.25


def plain_likeness(a, b, width=12):
    m = prefixhash.MARK * (width - 1)
    x, y = ({(m + t + m)[i : i + width] for i in range(len(t) + width - 1)} for t in (a, b))
    return 2 * len(x & y) / (len(x) + len(y))


def test_likeness_of_short_and_long_texts_changes_steadily(documents):
    long = "The quick brown fox jumps over the lazy dog at dawn."
    (found,) = [r for r in prefixhash.fingerprints(documents((2, long), (1, ""))).collect() if r.doc_id == 2]
    assert abs(found.near_edited - plain_likeness(long, long[:26])) < 0.15 and found.near_edited > 0.4 and found.near_next == 0
    before = {}
    for n in range(1, 200):
        text = "".join(chr(0x4E00 + i) for i in range(n))
        for kind, other in enumerate((text + "!", text[: n - n // 2], text[:-1], "".join(chr(0x8000 + i) for i in range(50)) + text[:1])):
            exact, now = plain_likeness(text, other), prefixhash.likeness(printed(text), printed(other))
            assert abs(now - exact) < (1e-9 if n < 25 and len(other) < 25 else 0.3)
            if n > 2:  # no length at which the measure itself jumps
                assert abs(exact - before[kind]) < 0.13
            before[kind] = exact
    assert prefixhash.likeness(printed(""), printed("")) == 1 and prefixhash.likeness(printed(""), printed("a")) == 0


def plain_removal(rows, window=13):
    large = 2**63 - 1
    words = [(large if i is None else i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for at in range(len(w) - window + 1):
            key = tuple(w[at : at + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, t), (number, w) in zip(rows, words):
        gone = [False] * len(w)
        for at in range(len(w) - window + 1):
            if first[tuple(w[at : at + window])] < number:
                gone[at : at + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def removed(df, **options):
    found = recompress.without_repeats(df, **options).collect()
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found)


def test_repeats_of_odd_rows(clashing):
    rows = [(r.doc_id, r.text) for r in clashing.collect()]
    assert removed(clashing) == plain_removal(rows)
    assert removed(clashing.limit(0)) == Counter()


@pytest.mark.parametrize("seed", range(3))
def test_repeats_of_random_passages(documents, seed, monkeypatch):
    monkeypatch.setattr(recompress, "BUCKET_BYTES", 3000)
    monkeypatch.setattr(recompress, "GROUP_BYTES", 2000)
    rng = np.random.default_rng(seed)
    pool = [" ".join(f"v{x}" for x in rng.integers(0, 9, rng.integers(5, 60))) for _ in range(12)]
    rows = []
    for i in rng.permutation(60).tolist():
        parts = [pool[int(rng.integers(0, 12))] if rng.random() < 0.6 else prose(int(rng.integers(0, 30)), i) for _ in range(4)]
        rows.append((None if i == 13 else i, "\t".join(parts)))
    rows += [(5, "same same " * 30), (50, "same " * 55), (51, "x " + "same " * 14), (52, "same " * 13), (53, "same " * 12)]
    assert removed(documents(*rows)) == plain_removal(rows)


def test_kept_text(documents):
    a = prose(40)
    found = recompress.without_repeats(documents((2, "start " + a + " end"), (1, a)), keep_text=True).collect()
    assert {r.doc_id: r.kept_text for r in found} == {1: a, 2: "start end"}


def test_equal_windows_decide_equal_letters():
    """Whatever stands around a window, the letters it decides are the same."""
    rng = np.random.default_rng(7)
    for _ in range(300):
        inner = rng.integers(0, 4, 13)
        seen = []
        for _ in range(3):
            left, right = rng.integers(0, 4, 20), rng.integers(0, 4, 20)
            names = recompress.mixed(np.concatenate([left, inner, right]).astype(np.uint64) + np.uint64(11))
            letters = recompress.recompressed(names, np.zeros(len(names), int))
            inside = (letters.low >= 20) & (letters.high <= 33)
            seen.append({(int(s) - 20, int(e) - 20, int(n)) for s, e, n in zip(letters.start[inside], letters.end[inside], letters.name[inside])})
        assert seen[0] == seen[1] == seen[2]


def test_packing_round_trip():
    rng = np.random.default_rng(3)
    e = {"name": rng.integers(0, 2**63, 500, dtype=np.uint64), "check": rng.integers(0, 2**32, 500, dtype=np.uint32)}
    e |= {"id": rng.integers(-5, 40, 500), "tag": rng.integers(0, 3, 500, dtype=np.uint32), "place": rng.integers(0, 2**20, 500, dtype=np.uint32)}
    back = recompress.unpacked(recompress.packed(**e), **recompress.OF_WINDOWS)
    assert Counter(zip(*(e[c].tolist() for c in e))) == Counter(zip(*(back[c].tolist() for c in e)))
