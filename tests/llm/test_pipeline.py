"""The pipeline on planted documents, stage by stage and as a whole."""

import random

import corpus_pipeline

WORDS = [f"v{i}" for i in range(500)]


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(n))


def planted(spark, folder):
    passage = prose(99, 60)
    rows = [(i, prose(i, 80)) for i in range(40)]
    rows += [(100, prose(0, 80)), (101, prose(1, 80) + " tail"), (102, f"{prose(700, 30)} {passage} {prose(701, 30)}"),
             (103, f"{prose(702, 30)} {passage} {prose(703, 30)}"), (104, prose(704, 40) + " You are an idiot and a loser. " + prose(705, 40)),
             (105, prose(706, 50) + " token=zz99zz99zz"), (106, None), (107, "")]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 5}", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, int(i == 104)) for i, _ in rows], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return dict(rows)


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    texts = planted(spark, folder)
    docs = first = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        if name != "packing":
            assert docs.schema.names == first.schema.names and docs.dtypes == first.dtypes
            kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    assert set(texts) - set(kept[0]) == {104}
    assert set(kept[0]) - set(kept[1]) == {100, 101}
    assert {i for i in kept[1] if kept[2][i] != kept[1][i]} == {103} and kept[2][103] == f"{prose(702, 30)} {prose(703, 30)}"
    assert {i for i in kept[2] if kept[3][i] != kept[2][i]} == {105} and kept[3][105].endswith(" [secret]")
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in packed} == set(kept[3])
    assert corpus_pipeline.ORACLE_SQL is None


def test_a_key_reused_in_two_sources_is_cut(spark):
    key = "AKIA" + "Q7" * 8
    docs = spark.createDataFrame([(i, f"{prose(710 + i, 40)} {key}", "en", f"s{i}", 9) for i in range(2)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert all(r["text"].endswith(" [secret]") for r in corpus_pipeline.redact_secrets(spark, docs, "").collect())
