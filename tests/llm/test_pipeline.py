import pathlib
from collections import Counter

import pytest
import tiktoken
from conftest_llm import prose
from test_bpe_simhash import PATTERN, RANKS, encoded, plain_components, plain_fingerprint
from test_exact_shards_mixture import normal

from recordflow.llm import bpe, exact, mixture, quality, simhash

ROOT = pathlib.Path(__file__).resolve().parents[2]
pipeline = pytest.importorskip("corpus_pipeline")


def junk(i):
    return " ".join(f"w{(k * i) % 83}###" for k in range(120))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with clean, rejected, copied, nearly copied, empty and null texts, and labels of some."""
    rows = [(i, prose(120 + i, i * 31) if i % 3 else junk(i), "en", f"s{i % 4}") for i in range(90)]
    rows += [(100 + i, rows[i * 3 + 1][1].replace(" ", "  "), "en", "s1") for i in range(8)]
    rows += [(200 + i, rows[i * 3 + 2][1] + " tail", "en", "s2") for i in range(8)]
    rows += [(300, None, None, None), (301, "", None, "s1"), (None, prose(90, 5), None, None), (302, prose(30_000, 7), "en", "s3")]
    rows += [rows[1], rows[1]]
    path = tmp_path_factory.mktemp("corpus")
    docs = [(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(bool(i % 3)), 0) for i in range(90)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_follow_a_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = docs.collect()
    good = [r for r, s in zip(rows, model.scores([r.text for r in rows], [r.n_chars for r in rows])) if s >= 0.5]
    assert {r.doc_id for r in good if r.doc_id is not None and r.doc_id < 90} == {i for i in range(90) if i % 3}
    first = {}
    for r in sorted(good, key=lambda r: (r.doc_id is None, r.doc_id or 0)):
        first.setdefault(normal(r.text), r)
    distinct = list(first.values())
    classes = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in distinct])
    near = {}
    for r, c in sorted(zip(distinct, classes), key=lambda x: (x[0].doc_id is None, x[0].doc_id or 0)):
        near.setdefault((c, plain_fingerprint(r.text) if c is None else None), r)
    kept = spark.createDataFrame(list(near.values()), docs.schema)
    copies = {r.doc_id: r.copies for r in mixture.mix(kept).collect()}
    ranks = bpe.parse_ranks(bpe.read_ranks(RANKS))
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in near.values():
        if copies[r.doc_id]:
            want[r.doc_id, encoded(encoding, r.text)] += copies[r.doc_id]
    found = pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, bytes(r.ids)) for r in found) == want and want
    assert all(r.n_tokens * 4 == len(r.ids) for r in found)


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixture", "encoding"]
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), folder).columns == docs.columns
    assert pipeline.STAGES[-1][1](spark, docs.limit(0), folder).collect() == []


def test_the_library_does_not_need_this_part():
    for path in (ROOT / "recordflow").rglob("*.py"):
        if "llm" not in path.parts:
            text = path.read_text()
            assert "recordflow.llm" not in text and "from ..llm" not in text and "corpus_pipeline" not in text, path
    assert exact and simhash
