import math
import random
from collections import Counter

import numpy as np
import xxhash
from conftest_llm import prose

from recordflow.llm import simhash


def stirred(h):
    h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    h = (h ^ h >> 27) * 0x94D049BB133111EB % 2**64
    return h ^ h >> 31


def plain_prints(text):
    """128 bits of five-word shingles, and four fingerprints of the words with their weights, bit by bit."""
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    hashes = [h | stirred(h) << 64 for h in hashes]
    of_shingles = sum(1 << b for b in range(128) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    weights = {w: int(256 * math.sqrt(n)) for w, n in Counter(words).items()}
    drawn = [(xxhash.xxh3_128_digest(w, 42) + xxhash.xxh3_128_digest(w, 43), n) for w, n in weights.items()]
    of_words = []
    for k in range(4):
        values = [(int.from_bytes(d[8 * k : 8 * k + 8], "little"), n) for d, n in drawn]
        whole = sum(weights.values())
        of_words.append(sum(1 << b for b in range(64) if 2 * sum(n for v, n in values if v >> b & 1) > whole))
    return of_shingles, of_words


def plain_classes(texts):
    """A number per text, the same for texts that links connect; all pairs are compared."""
    prints = [plain_prints(t) for t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (s, w) in enumerate(prints):
        for j, (t, v) in enumerate(prints[:i]):
            if (s ^ t).bit_count() <= simhash.APART and any((a ^ b).bit_count() <= 4 for a, b in zip(w, v)):
                root[top(i)] = top(j)
    return [top(i) for i in range(len(texts))]


def wanted(rows):
    classes = plain_classes([t for _, t in rows])
    least = {}
    for (i, _), c in zip(rows, classes):
        least[c] = min((x for x in (least.get(c), i) if x is not None), default=None)
    return Counter((i, least[c]) for (i, _), c in zip(rows, classes)), len(least)


def found(df, **options):
    return Counter((r.doc_id, r.component_id) for r in simhash.similar_groups(df, **options).collect())


def test_odd_rows(clashing):
    rows = [(r.doc_id, r.text) for r in clashing.collect()]
    want, classes = wanted(rows)
    assert found(clashing) == want
    kept = simhash.drop_similar(clashing)
    assert kept.columns == clashing.columns and kept.count() == classes
    assert simhash.similar_groups(clashing.limit(0)).collect() == [] and simhash.drop_similar(clashing.limit(0)).collect() == []


def changed(words, share, rng):
    """A copy in which some words are replaced."""
    return [f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def similarity(a, b):
    a, b = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (a, b))
    return len(a & b) / len(a | b)


def test_large_buckets_give_the_same(spark, documents):
    rng = random.Random(5)
    base = [f"v{rng.randrange(3000)}" for _ in range(200)]
    texts = [" ".join(changed(base, 0.02, rng)) for _ in range(120)] + [prose(150, 7 * i) for i in range(20)] + ["", None, "", "a b"]
    docs = documents(*enumerate(texts))
    want, _ = wanted(list(enumerate(texts)))
    assert found(docs) == want == found(docs, large=3)


def test_near_copies_of_a_similarity_of_eight_tenths_are_found(spark, documents):
    rng, rows, pairs, at = random.Random(11), [], {}, 0
    while len(pairs) < 300:
        words = [f"v{int(rng.paretovariate(0.6)) % 5000}" for _ in range(rng.choice((60, 200, 600, 2000)))]
        copy = changed(words, rng.choice((0.005, 0.01, 0.02, 0.022)), rng)
        if (s := similarity(words, copy)) < 0.8 or s == 1:
            continue
        rows += [(at, " ".join(words)), (at + 1, " ".join(copy))]
        pairs[at], at = s, at + 2
    # Unrelated texts of one small vocabulary: their sets of words agree.
    clean = [" ".join(f"v{rng.randrange(300)}" for _ in range(3000)) for _ in range(40)]
    rows += [(at + i, t) for i, t in enumerate(clean)]
    class_of = {r.doc_id: r.component_id for r in simhash.similar_groups(documents(*rows)).collect()}
    caught = {a: class_of[a] == class_of[a + 1] for a in pairs}
    assert np.mean(list(caught.values())) >= 0.95
    assert np.mean([caught[a] for a, s in pairs.items() if s < 0.85]) >= 0.9
    assert all(class_of[a] == a for a in list(pairs) + [at + i for i in range(40)])
