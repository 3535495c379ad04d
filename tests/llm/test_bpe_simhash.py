from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash
from conftest_llm import prose

from recordflow.llm import bpe, simhash
from recordflow.llm.components import components

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoding():
    ranks = bpe.parse_ranks(bpe.read_ranks(RANKS))
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(encoding, text):
    return np.array(encoding.encode_ordinary(text or ""), "<u4").tobytes()


@pytest.mark.parametrize("chunk, overlap", [(bpe.CHUNK, bpe.OVERLAP), (1000, 100)])
def test_encoding_of_odd_rows(clashing, encoding, chunk, overlap):
    df = bpe.decode(bpe.encode(clashing, RANKS, PATTERN, chunk=chunk, overlap=overlap), RANKS)
    found = Counter((r.doc_id, bytes(r.ids), r.n_tokens, bytes(r.decoded)) for r in df.collect())
    rows = [(r.doc_id, r.text or "") for r in clashing.collect()]
    assert found == Counter((i, e := encoded(encoding, t), len(e) // 4, t.encode()) for i, t in rows)


def test_chunks_within_blanks_contractions_and_long_words(documents, encoding):
    texts = ["a" * 3000 + " b  \n\n  c", "he'll  say 12\t 'réé\n\n\n x " * 200, " " * 2500 + "x", "\n\n" * 900 + "y'r", "ab " * 50 + "z" * 300 + " it's" * 90]
    docs = documents(*enumerate(texts), (0, texts[0]))
    found = bpe.encode(docs, RANKS, PATTERN, chunk=90, overlap=30).collect()
    assert Counter((r.doc_id, bytes(r.ids)) for r in found) == Counter([(i, encoded(encoding, t)) for i, t in enumerate(texts)] + [(0, encoded(encoding, texts[0]))])


def test_stitches_are_boundaries_of_the_whole():
    pattern, text = regex.compile(PATTERN), prose(400)
    whole = {m.start() for m in pattern.finditer(text)}
    for at in range(40, 200):
        place = bpe.stitch(pattern, text[: at + 60], text[at:], at)
        assert place is None or (place in whole and place > at)


def test_encoding_of_nothing(documents):
    assert bpe.encode(documents(), RANKS, PATTERN).collect() == []


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    """values: [(id, number)]; the smallest id reachable through numbers at most four bits apart."""
    root = list(range(len(values)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i][1] ^ values[j][1]).bit_count() <= 4:
                root[top(i)] = top(j)
    ids = {}
    for i, (doc_id, _) in enumerate(values):
        ids.setdefault(top(i), []).append(doc_id)
    return [min((x for x in ids[top(i)] if x is not None), default=None) for i in range(len(values))]


def test_near_groups_of_odd_rows(clashing):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in clashing.collect()]
    want = Counter((i, f"{f:016x}", c) for (i, f), c in zip(rows, plain_components(rows)))
    found = simhash.near_groups(clashing).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == want
    kept = simhash.drop_near(clashing)
    assert kept.columns == clashing.columns and kept.count() == len({c for _, _, c in want})
    assert simhash.near_groups(clashing.limit(0)).collect() == []


def test_words_across_blocks():
    text = prose(5000) + "  É Ä tail"
    words = [w for block in simhash.shingle_hashes(text, 4, 42) for w in block.tolist()]
    old, simhash_block = simhash.word_blocks.__defaults__, 100
    try:
        simhash.word_blocks.__defaults__ = (simhash_block,)
        assert [w for block in simhash.shingle_hashes(text, 4, 42) for w in block.tolist()] == words
        assert simhash.simhash(text) == plain_fingerprint(text)
    finally:
        simhash.word_blocks.__defaults__ = old


@pytest.mark.parametrize("step", [1, 19])
def test_masks_cover_every_difference(step):
    """Each set of at most four positions is hidden by some mask: their vectors are orthogonal to some v."""
    family = simhash.masks(4, step)
    assert len(family) == 31 and all(28 <= m.bit_count() <= 36 for m in family)
    rng = np.random.default_rng(1)
    for _ in range(3000):
        different = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(m & different == 0 for m in family)


@pytest.mark.parametrize("large", [3, 2000])
def test_links_lose_no_pair(spark, large):
    rng = np.random.default_rng(5)
    values = set()
    for centre in rng.integers(0, 2**63, 12, dtype=np.int64).tolist():
        for _ in range(25):
            flips = rng.choice(64, rng.integers(0, 7), replace=False)
            values.add(centre ^ sum(1 << int(b) for b in flips))
    values = sorted(values)
    df = spark.createDataFrame([(simhash._signed(v & (1 << 64) - 1),) for v in values], "fp long")
    made = {frozenset((r.u, r.v)) for r in simhash.links(df, large=large).collect()}
    assert all((a ^ b).bit_count() <= 4 or (a ^ b) < 0 for a, b in map(tuple, made))
    pairs = [(simhash._signed(v & (1 << 64) - 1), v) for v in values]
    want = plain_components(pairs)
    links = dict.fromkeys([p[0] for p in pairs])
    root = {x: x for x in links}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in map(tuple, made):
        root[max(top(a), top(b))] = min(top(a), top(b))
    assert [top(p[0]) for p in pairs] == want


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.root for r in found} == {n: 0 if n < 100 else 100 if n < 200 else 200 for e in edges for n in e}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
