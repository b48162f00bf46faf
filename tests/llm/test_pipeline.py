"""The registered queries and the pipeline over small tables, odd rows included."""

from collections import Counter

import pytest

import corpus_pipeline
from cases import ODD, documents, words
from dockflow.llm import mixing, near_dedup, quality_crf
from dockflow.llm.queries import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Good and bad texts with copies and near copies, beside the odd rows."""
    docs, labels = list(ODD), []
    for i in range(100, 220):
        text = "\n".join(words(12, 50 * i + 7 * k) + "." for k in range(8))
        if i % 5 == 0:
            text = "\n".join(" ".join(w + "$$$" for w in line.split()) for line in text.split("\n"))
        docs.append((i, text, "en", "abc"[i % 3], len(text)))
        labels.append((i, int(i % 5 != 0), int(i % 7 == 0)))
        if i % 10 == 1:
            docs.append((1000 + i, text, "en", "a", len(text)))
        if i % 10 == 2:
            docs.append((2000 + i, text.replace(text.split()[5], "changed", 1), "en", "b", len(text)))
    base = str(tmp_path_factory.mktemp("sf"))
    documents(spark, docs).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, "http://www.free-bets.example.com/en/1", None), (2, None, None)],
                          "page_id long, url string, html string").write.parquet(f"{base}/pages.parquet")
    spark.createDataFrame([(k, t, ("user", "assistant")[t % 2], f"Turn {t}.") for k in range(40) for t in range(4)],
                          "conv_id long, turn int, role string, text string").write.parquet(f"{base}/conversations.parquet")
    return base


def test_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in queries()] == list(range(1, 14))


def test_pipeline_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mix", "encode"]
    accepted = corpus_pipeline.quality(spark, docs, sf_dir)
    scores = Counter((r.doc_id, r.score >= 0.7) for r in quality_crf.judge(docs, labels).collect())
    assert Counter(r.doc_id for r in accepted.collect()) == Counter(
        {i: n for (i, good), n in scores.items() if good})
    kept = {r.doc_id for r in accepted.collect()}
    good = [i for i in range(100, 220) if i % 5]
    assert len(kept & set(good)) >= 0.97 * len(good)
    assert len(kept & set(range(100, 220, 5))) <= 2

    exact = corpus_pipeline.exact(spark, accepted, sf_dir)
    by_text = {}
    for r in accepted.collect():
        by_text[r.text] = max((r.doc_id for r in [r] if r.doc_id), default=0) if r.text not in by_text else max(
            by_text[r.text], r.doc_id or 0)
    assert Counter((r.text, r.doc_id or 0) for r in exact.collect()) == Counter(by_text.items())

    near = corpus_pipeline.near(spark, exact, sf_dir)
    classes = near_dedup.classes(exact).collect()
    assert near.count() == len({r.class_id for r in classes}) < exact.count()
    assert {r.doc_id for r in near.collect()} == {r.class_id for r in classes}

    mixed = corpus_pipeline.mix(spark, near, sf_dir)
    copies = {r.doc_id: r.copies for r in mixing.mix(near).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: c for i, c in copies.items() if c})
    for stage in (accepted, exact, near, mixed):
        assert stage.columns == COLUMNS

    encoded = corpus_pipeline.encode(spark, mixed, sf_dir)
    assert Counter(r.doc_id for r in encoded.collect()) == Counter(r.doc_id for r in mixed.collect())
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in encoded.collect())
    ran = corpus_pipeline.run(spark, sf_dir)
    assert Counter(r.doc_id for r in ran.collect()) == Counter(r.doc_id for r in encoded.collect())


@pytest.mark.parametrize("name", list(queries()))
def test_queries_return_every_row(spark, sf_dir, name):
    got = queries()[name](spark, sf_dir)
    key, source = {"op6": ("page_id", "pages"), "op11": ("conv_id", "conversations")}.get(
        name.split("_")[0], ("doc_id", "documents"))
    given = spark.read.parquet(f"{sf_dir}/{source}.parquet").select(key)
    want = Counter(r[0] for r in (given.distinct() if key == "conv_id" else given).collect())
    assert Counter(r[0] for r in got.select(key).collect()) == want


def test_empty_tables(spark, sf_dir, tmp_path):
    for name in ("documents", "labels", "pages", "conversations"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name, query in queries().items():
        assert query(spark, str(tmp_path)).collect() == [], name
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
