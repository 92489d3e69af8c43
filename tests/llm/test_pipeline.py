"""The corpus pipeline, stage by stage, against brute-force versions, and
the registered queries."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm import language, mixing, quality, queries, simhash
from tessera.llm.common import crc_mod


@pytest.fixture(scope="module")
def stages(spark, sf_small, documents, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), documents, [documents]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_small).write.parquet(str(folder / str(i)))
        docs = spark.read.parquet(str(folder / str(i)))
        out.append(docs)
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_order_and_columns(stages, documents):
    assert [name.split()[0] for name, _ in corpus_pipeline.STAGES] == ["language", "quality", "SimHash", "mixing",
                                                                       "SentencePiece"]
    for df in stages[:-1]:
        assert df.columns == documents.columns
    assert stages[-1].columns == [*documents.columns, "n_tokens", "ids"]


def test_language_stage(stages):
    docs = stages[0]
    learned = language.fit(docs.where(crc_mod("doc_id", 5) != 0))
    want = [r["row"]["doc_id"] for r in language.predict(docs, learned).collect()
            if r["lang_pred"] != language.UNKNOWN and r["score"] >= corpus_pipeline.MIN_LANGUAGE]
    assert ids(stages[1]) == sorted(want)


def test_quality_stage_keeps_what_is_labelled_good(spark, sf_small, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    kept = set(ids(stages[2]))
    known = [i for i in ids(stages[1]) if i in labels]
    assert sum((i in kept) == bool(labels[i]) for i in known) / len(known) > 0.95


def test_near_duplicate_stage_keeps_one_of_each_group(stages):
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(stages[2]).collect()}
    assert ids(stages[3]) == sorted(set(found.values()))


def test_near_duplicate_stage_goes_by_rows(spark, sf_small):
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(40)) for w in ("alpha", "beta", "gamma", "delta"))
    rows = [(3, a), (7, a), (7, b), (9, b), (9, c), (9, c), (None, a), *[(None, d)] * 50, (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, sf_small).collect()
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in got)
    assert kept == [(0, ""), (0, d), (3, a), (7, b), (9, c)]


def test_mixing_stage_follows_the_rates(spark, sf_small, stages):
    rates, _ = mixing.mix(stages[3], queries.labelled(spark, sf_small), queries.TARGETS)
    want = [r["doc_id"] for r in rates.withColumn("n", mixing.copies(F.col("rate"), F.col("doc_id"))).collect() if r["n"]]
    assert ids(stages[4]) == sorted(want)


def test_mixing_stage_keeps_clean_documents(spark, tmp_path):
    # next to no low document is left: the clean ones must not go with them
    rows = [(i if i % 3 else None, f"lovely words number x{i} of some text", "en", "s", 9) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 0, int(i != 1)) for i in range(300) if i % 3], "doc_id long, toxic int, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = corpus_pipeline.mix(spark, docs, str(tmp_path))
    assert kept.where("doc_id <> 1").distinct().count() > 0.95 * 199


def test_mixing_stage_draws_rows_without_an_id(spark, tmp_path, monkeypatch):
    rows = [(i if i % 2 else None, ("awful " if i % 4 < 2 else "lovely ") + f"text x{i}", "en", "s", 9) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, int(i % 4 < 2), 1) for i in range(400) if i % 2], "doc_id long, toxic int, quality int"
                          ).write.parquet(str(tmp_path / "labels.parquet"))
    monkeypatch.setattr(queries, "TARGETS", {"clean": 0.9, "toxic": 0.1})
    kept = corpus_pipeline.mix(spark, docs, str(tmp_path)).where("doc_id IS NULL")
    toxic = kept.where("text LIKE 'awful%'").count()
    assert 0 < toxic < 60  # of 100
    assert kept.count() - toxic > 150  # of 100, repeated


def test_last_stage_encodes_what_is_left(stages):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer(queries.PIECES))
    rows = stages[5].collect()
    assert len(rows) == stages[4].count()
    for r in rows:
        assert r["ids"] == lib.encode(r["text"], add_bos=True, add_eos=True) and r["n_tokens"] == len(r["ids"])


def test_run_equals_the_stages(spark, sf_small, stages):
    assert ids(corpus_pipeline.run(spark, sf_small)) == ids(stages[5])


def test_stages_take_odd_and_empty_documents(spark, sf_small, odd, empty):
    for df in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, df, sf_small).count() <= df.count()
    assert corpus_pipeline.near_duplicates(spark, odd, sf_small).where("doc_id = 3").count() == 1


def test_rejects_are_the_threshold(spark, sf_small, stages):
    train = spark.read.parquet(f"{sf_small}/labels.parquet").where(crc_mod("doc_id", 4) != 2)
    scored = quality.scores(stages[1], quality.fit(stages[1], train)).collect()
    assert ids(stages[2]) == sorted(r["row"]["doc_id"] for r in scored if r["score"] >= quality.THRESHOLD)


def test_registered():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {x.split("_")[0] + "_" for x in names} and "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.all_sql()))
def test_sql(spark, sf_small, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = queries.all_queries()[name](spark, sf_small)
    cur = con.execute(queries.all_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(cur.fetchall())


def test_clashing_columns_are_replaced_by_the_last_stage(spark, tmp_path):
    df = spark.createDataFrame([(1, "some text", "x", "y", 1.5)], "doc_id long, text string, ids string, N_TOKENS string, `a.b` double")
    corpus_pipeline.sentencepiece(spark, df, "").write.parquet(str(tmp_path / "out"))
    (row,) = spark.read.parquet(str(tmp_path / "out")).collect()
    assert row["n_tokens"] == len(row["ids"]) > 2 and row["a.b"] == 1.5 and len(row) == 5


def test_a_repeated_labelled_id_is_collected_once(spark, monkeypatch):
    from tessera.llm import quality

    seen = []
    monkeypatch.setattr(quality, "fit_model", lambda x, y: seen.append((x, y)))
    docs = spark.createDataFrame([(1, f"text number {i}") for i in range(300)] + [(2, "two"), (None, "no id")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] * 50 + [(1, 0), (2, 1), (3, 1), (None, 1)], "doc_id long, quality int")
    quality.fit(docs, labels)
    (x, y), = seen
    assert len(x) == 2 and sorted(y) == [0.0, 1.0]


def test_last_stage_decodes_what_it_encodes(spark, tmp_path):
    from pyspark.sql import Observation

    rows = [(1, "Some text, and more."), (2, ""), (3, None), (4, "a▁b")]  # the last one comes back as "a b"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = Observation()
    corpus_pipeline.sentencepiece(spark, df, "", seen).write.parquet(str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert seen.get == {"n_docs": 4, "n_ids": sum(r["n_tokens"] for r in out), "n_same": 3}
