"""Token files, ranked search of many items and the manifest, each against a plain version."""

import glob
import hashlib
import math
import random
import zlib
from array import array
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from recordflow.llm import lexical, merkle, tokenfiles

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.01"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@pytest.fixture(scope="module")
def plain_tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    return t


# Token files


def plain_files(rows, tokenizer, end=2):
    """doc_id, start, n_tokens, ids_crc32 of rows in order."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc_id, start, len(ids), zlib.crc32(array("I", ids).tobytes())))
        start += len(ids)
    return out


def written(spark, docs, tmp_path, **options):
    path = f"{tmp_path}/tokens"
    tokenfiles.write(docs, TOKENIZER, path, 2, **options)
    return path


def digests(spark, path):
    return tokenfiles.checksums(tokenfiles.read(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")


def test_files_of_the_table(spark, tmp_path, plain_tokenizer):
    docs = table(spark, SF, "documents")
    path = written(spark, docs, tmp_path)
    want = plain_files(sorted((r.doc_id, r.text) for r in docs.collect()), plain_tokenizer)
    assert sorted(map(tuple, digests(spark, path).collect())) == want
    assert [r[:] for r in tokenfiles.starts(spark, path).orderBy("doc_id").select("doc_id", "start", "n_tokens").collect()] == [w[:3] for w in want]


@pytest.mark.parametrize("stretch", [1 << 20, 64])
def test_pieces_give_the_ids_of_whole_texts(plain_tokenizer, monkeypatch, stretch):
    monkeypatch.setattr(tokenfiles, "STRETCH", stretch)
    monkeypatch.setattr(tokenfiles, "KEPT_PIECES", 500)
    encoder = tokenfiles.PieceEncoder(tokenfiles.read_vocabulary(TOKENIZER))
    rng = random.Random(4)
    letters = [*" \n\t\r\x0b  aZ1'.!(é漢\x1c\x1f\x85\xa0 　᠎​\x7f\x00½²ª٣ſ🙂", "'s", "'ll", " '", "<|endoftext|>", "''", "n't", "\n\n", " the"]
    texts = ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(4000)] + ["x" * 5000, " " * 300, "", "ab \n" * 800]
    ids, counts = encoder.encode(pa.array(texts))
    at = 0
    for text, n in zip(texts, counts.tolist()):
        assert ids[at : at + n].tolist() == plain_tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
        at += n


def test_files_of_odd_rows(spark, odd, clashing, tmp_path, plain_tokenizer):
    path = written(spark, clashing.repartition(3), tmp_path)
    got = digests(spark, path).collect()
    assert len(got) == odd.count()
    by_id = Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got)
    want = plain_files([(r.doc_id, r.text) for r in odd.collect()], plain_tokenizer)
    assert by_id == Counter((d, n, c) for d, _, n, c in want)
    # Starts follow each other without a gap, in ascending order of ids, null ids last.
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda d: (d is None, d or 0))


def test_an_empty_table_gives_no_rows(spark, documents, tmp_path):
    path = written(spark, documents((1, "a")).filter("false"), tmp_path)
    assert digests(spark, path).collect() == [] and tokenfiles.starts(spark, path).collect() == []


@pytest.mark.parametrize("encoding, name", [("dictionary", "RLE_DICTIONARY"), ("delta", "DELTA_BINARY_PACKED")])
def test_files_have_the_encodings_groups_and_indexes_asked_for(spark, tmp_path, encoding, name):
    docs = table(spark, SF, "documents")
    path = written(spark, docs, tmp_path, ids_encoding=encoding, row_group_bytes=64 << 10, page_rows=50)
    groups = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        groups += meta.num_row_groups
        for i in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                column = meta.row_group(i).column(c)
                wanted = name if column.path_in_schema == "ids.list.element" else "DELTA_BINARY_PACKED"
                assert wanted in column.encodings and column.has_column_index and column.has_offset_index
    assert groups > len(glob.glob(f"{path}/*.parquet"))
    with pytest.raises(ValueError):
        tokenfiles.write(docs, TOKENIZER, f"{path}-more", 2, ids_encoding="plain")


def test_selective_reads(spark, tmp_path):
    docs = table(spark, SF, "documents")
    path = written(spark, docs, tmp_path)
    some = tokenfiles.read(spark, path, F.col("doc_id").between(100, 120))
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,100)" in some._jdf.queryExecution().toString()
    every = {r.doc_id: r for r in tokenfiles.read(spark, path).collect()}
    got = some.collect()
    assert got and all(every[r.doc_id] == r for r in got) and all(100 <= r.doc_id <= 120 for r in got)
    plan = tokenfiles.starts(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ids:array" not in plan


# Ranked search


def plain_terms(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            out += [word] if word else []
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return out


def plain_search(docs, items, best=20):
    """item row, item_id, rank, doc_id, score by scoring every document for every item."""
    found = [(d, Counter(ws), len(ws)) for d, t in docs for ws in [plain_terms(t)]]
    n_docs, n_terms = sum(n > 0 for *_, n in found), sum(n for *_, n in found)
    df = Counter(w for _, c, _ in found for w in c)
    out = []
    for item_id, text in items:
        scores = []
        for d, tf, n in found:
            m = 75 + (25 * n * n_docs) // max(1, n_terms)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * tf[w] // (1000 * tf[w] + 12 * m)) for w in plain_terms(text) if tf[w])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item_id, i, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scores)[:best], 1)]
    return sorted(out, key=str)


def items_of(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("limits", [{}, {"graph_terms": 200, "round_bytes": 20_000}])
def test_search_of_the_table(spark, limits):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = plain_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert found(lexical.search(docs, items, **limits)) == want


def test_search_of_odd_rows(spark, clashing, odd):
    items = items_of(spark, (1, "alpha BETA alpha w3"), (1, "alpha"), (2, None), (3, ""), (None, "naïve Naïve 漢字 12 zoë"), (4, "nothing of this"), (1, "alpha"))
    want = plain_search([(r.doc_id, r.text) for r in odd.collect()], [(r.item_id, r.text) for r in items.collect()], 5)
    clash = items.withColumns({n: F.lit("x") for n in ("doc_id", "_item", "words", "_hash", "_size", "rank")})
    assert found(lexical.search(clashing.repartition(5), clash, best=5)) == want


def test_search_of_empty_tables(spark, documents):
    docs, items = documents((1, "alpha")), items_of(spark, (1, "alpha"))
    assert found(lexical.search(docs.filter("false"), items)) == []
    assert found(lexical.search(docs, items.filter("false"))) == []
    assert found(lexical.search(documents((1, None), (2, " ")), items)) == []


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = "Alpha, béta " * 500 + "x" * 300
    whole = [w for part in lexical.terms(text) for w in part]
    monkeypatch.setattr(lexical, "STRETCH", 20)
    assert [w for part in lexical.terms(text) for w in part] == whole and whole[:2] == [b"alpha", "béta".encode()]


def test_items_share_their_sums():
    rng = random.Random(2)
    common = [[b"s%d" % i for i in range(k, k + 12)] for k in range(0, 60, 6)]
    items = {i: Counter(rng.choice(common) + rng.choice(common) + [b"o%d" % rng.randrange(99) for _ in range(5)]) for i in range(80)}
    graph = lexical.shared(items)
    # A plain evaluation of the graph gives each item its own terms back.
    rows = [Counter({w: 1}) for w in graph.words]

    def combined(parts):
        out = Counter()
        for row, count in parts:
            for w, n in rows[row].items():
                out[w] += n * count
        return out

    for parts in graph.parts:
        rows.append(combined(parts))
    assert {i: combined(parts) for i, parts in graph.items.items()} == items
    assert graph.additions() < sum(len(c) - 1 for c in items.values()) / 2


# Manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves):
    made = [leaves]
    while len(made[-1]) > 1:
        made.append([sha("".join(made[-1][i : i + 16])) for i in range(0, len(made[-1]), 16)])
    return made


def plain_way(made, at):
    out = []
    for nodes in made[:-1]:
        run = at - at % 16
        out.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 16])))
        at //= 16
    return out


def tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def plain_manifest(rows):
    low = str.maketrans(merkle.UPPER, merkle.LOWER)
    of = {}
    for r in rows:
        values = (r.doc_id, r.source, r.lang, r.n_chars)
        leaf = sha("".join(map(frame, (*values, r.text))))
        new = sha("".join(map(frame, (*values, r.text and r.text.translate(low))))) if tampered(r.doc_id) else None
        of.setdefault(r.source, []).append((r.doc_id, leaf, new))
    sources = sorted(of, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        of[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: plain_tree([leaf for _, leaf, _ in of[s]]) for s in sources}
    top = plain_tree([trees[s][-1][0] for s in sources]) if sources else []
    out = []
    for i, s in enumerate(sources):
        for at, (doc_id, leaf, new) in enumerate(of[s]):
            way, now = plain_way(trees[s], at) + plain_way(top, i), new or leaf
            for left, right in way:
                now = sha(left + now + right)
            proof = sha("".join(a + b for a, b in way))
            out.append((doc_id, leaf, trees[s][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return sorted(out, key=str)


def made(docs):
    return merkle.manifest(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.lower_cased())


def proofs(docs):
    return sorted(map(tuple, made(docs).proofs().collect()), key=str)


def test_manifest_of_the_table(spark):
    docs = table(spark, SF, "documents")
    got = proofs(docs)
    assert got == plain_manifest(docs.collect()) and 0 < sum(not r[-1] for r in got) < len(got)


def test_manifest_of_odd_rows(spark, odd, clashing, documents):
    assert proofs(clashing) == plain_manifest(odd.collect())
    mixed = documents((1, "One", "b"), (2, "Two", None), (3, "", None), (None, None, "B"), (5, "Five", "é"), (5, "Five", "é"), (4, "", ""))
    assert proofs(mixed) == plain_manifest(mixed.collect())
    assert proofs(documents((1, "Alone", "a"))) == plain_manifest(documents((1, "Alone", "a")).collect())
    assert proofs(mixed.filter("false")) == []


@pytest.mark.parametrize("rows", [4096, 4097, 5000, 70_000])
def test_manifest_of_several_storeys(spark, rows):
    docs = spark.range(rows).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), "id").alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") % 50 == 0, F.concat(F.lit("s"), F.col("id") % 7)).otherwise("hot").alias("source"), F.lit(9).cast("long").alias("n_chars"),
    )
    assert proofs(docs) == plain_manifest(docs.collect())


def test_versions_share_what_they_do_not_copy(spark):
    docs = table(spark, SF, "documents").filter("source in ('src0', 'src1')")
    tree = made(docs)
    nodes = {(r.source, r.level, r.pos): r.digest for r in tree.nodes().collect()}
    changed = {}
    for r in tree.versions().collect():
        changed.setdefault((r.doc_id, r.source, r.leaf_pos), {})[r.level] = r.digest
    assert len(changed) == sum(tampered(r.doc_id) for r in docs.collect())
    for (_, source, at), copies in changed.items():
        # The first version with the copies laid over it is the tree over the changed leaves.
        leaves = [nodes[source, 0, i] for i in range(sum(k[:2] == (source, 0) for k in nodes))]
        leaves[at] = copies[0]
        for level, digests_ in enumerate(plain_tree(leaves)):
            for i, digest in enumerate(digests_):
                assert digest == (copies[level] if i == at >> 4 * level else nodes[source, level, i])
