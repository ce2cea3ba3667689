from __future__ import annotations

import random

import pyarrow as pa
import pyarrow.parquet as pq

import corpus_pipeline
from chalkline.llm import decontam, linededup, queries, simhash

from .conftest import sentence


def write(folder, docs, labels, items):
    pq.write_table(pa.table({"doc_id": pa.array([d[0] for d in docs], pa.int64()), "text": pa.array([d[1] for d in docs], pa.string()), "lang": pa.array(["en"] * len(docs)), "source": pa.array(["s"] * len(docs)), "n_chars": pa.array([len(d[1] or "") for d in docs], pa.int64())}), f"{folder}/documents.parquet")
    pq.write_table(pa.table({"doc_id": pa.array([x[0] for x in labels], pa.int64()), "quality": pa.array([1] * len(labels), pa.int32()), "toxic": pa.array([x[1] for x in labels], pa.int32())}), f"{folder}/labels.parquet")
    pq.write_table(pa.table({"item_id": pa.array([x[0] for x in items], pa.int64()), "text": pa.array([x[1] for x in items], pa.string())}), f"{folder}/benchmark.parquet")


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(0)
    docs = [(i, "\n".join(sentence(rng, 20) for _ in range(4))) for i in range(150)]
    toxic = {i for i in range(150) if i % 7 == 3}
    docs = [(i, t + (f"\nyou insultus {sentence(rng, 3)} insultus" if i in toxic else "")) for i, t in docs]
    passage, item = "\n".join(sentence(rng, 15) for _ in range(4)), sentence(rng, 25)
    docs += [(200, f"{sentence(rng, 40)}\n{passage}"), (201, f"{passage}\n{sentence(rng, 45)}"), (202, f"{sentence(rng, 30)} {item}"), (203, docs[0][1].split("\n")[0]), (204, docs[0][1].split("\n")[0]), (205, None), (206, "")]
    write(tmp_path, docs, [(i, int(i in toxic)) for i in range(120)], [(1, item)])
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    table, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = table
        table = stage(spark, table, str(tmp_path))
        assert table.columns == before.columns and [t for _, t in table.dtypes] == [t for _, t in before.dtypes], name
        table = spark.createDataFrame(table.collect(), table.schema)
        seen.append({r.doc_id: r for r in table.collect()})
    assert set(seen[0]) == {i for i, _ in docs} - toxic
    assert set(seen[1]) == set(seen[0]) and passage not in seen[1][201].text and passage in seen[1][200].text
    assert seen[1][201].n_chars == len(seen[1][201].text) and seen[1][205].text is None
    assert set(seen[1]) - set(seen[2]) == {204, 206} and set(seen[2]) - set(seen[3]) == {202}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in packed} == set(seen[3])
    assert sum(p.length for p in packed) == sum({p.doc_id: p.doc_tokens for p in packed}.values())


def test_odd_tables(spark, tmp_path):
    from pyspark.sql import functions as F

    rng = random.Random(3)
    long = ". ".join(sentence(rng, 12).capitalize() for _ in range(1700))
    text = sentence(rng, 80)
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, text), (None, None), (4, long), (5, f"{sentence(rng, 30)}\n{long}"), (6, " \n\t"), (7, "x"), (8, "x"), (2, "y " * 60)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("__doc", "__TH", "__gone", "__bad", "th", "fp", "root", "run", "item_id", "key"):
        docs = docs.withColumn(name, F.lit(name))
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 1), (99, 1, 1), (7, 0, None)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, None), (None, "..."), (2, "")], "item_id long, text string")
    for case, table in (("odd", docs), ("none", docs.limit(0))):
        folder = f"{tmp_path}/{case}"
        for name, df in (("documents", table), ("labels", labels if case == "odd" else labels.limit(0)), ("benchmark", items if case == "odd" else items.limit(0))):
            df.write.parquet(f"{folder}/{name}.parquet")
        now = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:4]:
            after = stage(spark, now, folder)
            assert after.columns == now.columns
            now = spark.createDataFrame(after.collect(), after.schema)
        ids = sorted(-1 if r.doc_id is None else r.doc_id for r in corpus_pipeline.run(spark, folder).select("doc_id").distinct().collect())
        # the null id's copy of the first text stands first, so its lines stay there and document 1 is left without any
        assert ids == sorted({-1 if r.doc_id is None else r.doc_id for r in now.collect()}) and (ids == [] if case == "none" else {4, 5, 7} <= set(ids))
        if case == "odd":
            kept = {(r.doc_id, r.text) for r in now.collect()}
            assert (4, long) in kept and {t for i, t in kept if i == 5} != {rows[7][1]} and sum(not (t or "").strip() for _, t in kept) == 1 and sum(t == "x" for _, t in kept) == 1


def test_registration():
    import __spark_entry__

    listed = __spark_entry__.queries()
    for n in range(1, 11):
        assert any(name.startswith(f"op{n}_") for name in listed)
    assert listed["pipeline"] is corpus_pipeline.run and "pipeline" not in __spark_entry__.oracle_sql()
    assert set(queries.oracle_sql()) <= set(queries.queries()) and set(__spark_entry__.oracle_sql()) <= set(listed)
    assert decontam.THRESHOLD == 0.8 and decontam.SHINGLE == 5 and linededup.MIN_WORDS == 50 and simhash.RADIUS == 3
