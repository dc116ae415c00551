"""The registered queries on the small tables, with SQL or plain versions; the pipeline stage by stage."""

import hashlib
from pathlib import Path

import brute
import duckdb
import pytest

import corpus_pipeline
from tideline.llm import queries
from tideline.llm.common import stored

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def rows_of(spark, name, *columns):
    return [tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, DATA).collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, db, name):
    df = queries.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    want = db.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, want)) and want


def test_plain_versions(spark, db):
    docs = db.sql("SELECT doc_id, text FROM documents").fetchall()
    items = db.sql("SELECT item_id, text FROM benchmark").fetchall()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = {d: (n, h, len(i), sha(",".join(sorted(map(str, i)))), h > 0) for d, (n, h, i) in brute.contamination(docs, items).items()}
    assert {r[0]: r[1:] for r in rows_of(spark, "op1_decontamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")} == want
    assert {r[0]: r[1:] for r in rows_of(spark, "op3_quality_rules", "doc_id", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")} == {d: brute.base_statistics(t) for d, t in docs}
    want = {d: (f"{f:016x}", c) for d, (f, c) in brute.simhash_components(docs).items()}
    assert {r[0]: r[1:] for r in rows_of(spark, "op6_simhash", "doc_id", "fingerprint", "component_id")} == want
    assert dict(rows_of(spark, "op8_line_dedup", "doc_id", "kept_sha256")) == {d: sha(t) for d, t in brute.deduplicated_lines(docs).items()}
    assert {r[0]: r[1:] for r in rows_of(spark, "op10_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")} == brute.removed_bytes(docs)
    assert dict(rows_of(spark, "op2_packing", "doc_id", "n_tokens")) == {d: len(brute.blank_words(t)) for d, t in docs}


def test_learned_queries(spark, db):
    rows = rows_of(spark, "op4_toxicity", "doc_id", "held_out", "score", "predicted")
    assert len(rows) == 200 and all(0 <= s <= 1 and p == (s >= 0.7) for _, _, s, p in rows)
    kept = dict(rows_of(spark, "op3_quality_rules", "doc_id", "kept"))
    good = [d for d, q in db.sql("SELECT doc_id, quality FROM labels JOIN documents USING (doc_id) WHERE quality = 1").fetchall()]
    failed = {d for d, t in db.sql("SELECT doc_id, text FROM documents").fetchall() if brute.base_statistics(t)[4]}
    assert all(kept[d] for d in good if d not in failed) and not any(kept[d] for d in failed)
    rows = rows_of(spark, "op9_chat_format", "conv_id", "n_turns", "n_found")
    assert sum(a == b for _, a, b in rows) / len(rows) > 0.9


def test_pipeline(spark, db):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = docs.columns
    items = db.sql("SELECT item_id, text FROM benchmark").fetchall()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stored(stage(spark, docs, DATA), f"test-{k}")
        if name == "packing":
            assert {r["doc_id"] for r in docs.collect()} == set(before)
            continue
        assert docs.columns == names
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        if name == "line dedup":
            want = brute.deduplicated_lines(list(before.items()))
            assert after == {d: t for d, t in want.items() if t == before[d] or t.strip()}
        elif name == "simhash near-dedup":
            assert set(after) == set(brute.jaccard_groups(list(before.items())).values())
        elif name == "benchmark decontamination":
            assert set(after) == {d for d, x in brute.contamination(list(before.items()), items).items() if not x[1]}
    assert sorted(map(str, corpus_pipeline.run(spark, DATA).collect())) == sorted(map(str, docs.collect()))


def test_pipeline_on_odd_rows(spark):
    """Nulls in any column, empty and blank texts, repeated rows, other columns with clashing names, no rows at all."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, h long, row string, kept int, words string, source_row int, t string, line int"
    good = " ".join(f"word{i} and some more text number {i}" for i in range(12))
    rows = [(1, good), (1, good), (2, None), (3, ""), (4, " \n\t"), (None, good + " tail"), (None, None), (5, good.replace("word3", "other")), (6, "\n".join([good] * 3)), (7, "short"), (8, "xyz " * 5000)]
    for data in (rows, []):
        docs = spark.createDataFrame([(*r, None, None, None, 7, "x", 1, "y", 2, "z", 3) for r in data], schema)
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            made = stored(stage(spark, docs, DATA), f"odd-{k}")
            assert made.count() <= docs.count()
            if name == "packing":
                assert made.count() == docs.count()
                break
            assert made.dtypes == docs.dtypes
            docs = made
        assert (1 in {r["doc_id"] for r in docs.collect()}) == bool(data)
