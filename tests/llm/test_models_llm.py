"""Toxicity, mixing, sharding and the pipeline."""

import itertools

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from fallscan.llm import mixing, sharding, toxicity

MORE = "doc_id long, text string, source string, lang string, size long, score double, c0 int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "en", 1, 0.5, 2) for i, t, s in rows], MORE)


ODD = [(1, None, "a"), (2, "", "a"), (None, "some words here", None), (3, "x " * 50_000, "b"), (4, "tie tie", "b"), (4, "tie tie", "b")]


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) >= 0.95
    assert not [r for r in rows if r.predicted and not r.toxic]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_toxicity_defined_cases(spark):
    docs = frame(spark, ODD)
    labels = spark.createDataFrame([(3, None, 1), (4, 1, 0)], "doc_id long, toxic int, quality int")
    found = toxicity.toxicity(docs, labels).collect()
    assert len(found) == len(ODD) and len({r.score for r in found}) == 1
    assert toxicity.toxicity(docs, labels.limit(0)).agg(F.max("score")).first()[0] == 0
    assert toxicity.toxicity(docs.limit(0), labels).isEmpty()
    assert toxicity.accepted(docs, labels.limit(0)).count() == len(ODD)


def test_disguised_words_count():
    plain = toxicity.features("you are an id10t and a l.o.s.e.r", {})
    at = dict(zip(toxicity.FEATURES, plain))
    assert at["disguised_hits"] > 0 and at["second_person_density"] > 0
    assert len(toxicity.features("", {})) == len(toxicity.FEATURES)


def expected_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, free, rest = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        full = [s for s in free if rest * weight[s] / total > 2 * sizes[s]]
        for s in full or free:
            target[s] = 2.0 * sizes[s] if full else rest * weight[s] / total
        if not full:
            break
        rest -= sum(target[s] for s in full)
        free -= set(full)
    return target


def test_mix_meets_its_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn(
        "source", F.when(F.col("source") != "src3", F.col("source"))
    )
    rows = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
    expected = expected_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(expected[s])
        assert abs(taken[s] - target[s]) <= 0.03 * target[s] + 20
    again = mixing.mix(docs.repartition(7)).collect()
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in again}


def test_mix_defined_cases(spark):
    docs = frame(spark, ODD)
    found = mixing.mix(docs).collect()
    assert len(found) == len(ODD) and all(r.taken == 0 for r in found if r.size == 0)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert mixing.mix(docs.limit(0)).isEmpty() and mixing.mixed(docs.limit(0)).isEmpty()


def test_rates_are_exponential_tilts(spark):
    rows = frame(spark, [(k, "w " * (k % 9 + 1), "ab"[k % 2]) for k in range(200)])
    sized = mixing.sized(rows)
    targets = mixing.source_targets(sized)
    goal = {r.source: r.target for r in targets.collect()}
    for source, part in itertools.groupby(
        sorted(mixing.rates(sized, targets).collect(), key=lambda r: r.source), lambda r: r.source
    ):
        part = list(part)
        assert sum(r.rate * r.size * r.n for r in part) == pytest.approx(goal[source], rel=1e-6)
        slopes = [np.log(r.rate) / r.size for r in part if r.rate < 2]
        assert np.ptp(slopes) < 1e-6 if slopes else True


@pytest.mark.parametrize("n, bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_is_a_path_through_all_cells(n, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
    index = sharding.hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    assert np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1).max() == 1


def test_shards_are_even_runs_of_the_curve(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sharding.shards(docs).collect()
    counts = [sum(r.shard == k for r in rows) for k in range(16)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == docs.count()
    for k in range(16):
        own = sorted((r.slot, r.position) for r in rows if r.shard == k)
        assert [s for s, _ in own] == list(range(counts[k]))
        assert [p for _, p in own] == sorted(p for _, p in own)
    again = sharding.shards(docs.repartition(5)).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_shards_defined_cases(spark, tmp_path):
    docs = frame(spark, ODD)
    found = sharding.shards(docs).collect()
    assert len(found) == len(ODD) and [r for r in found if r.doc_id == 1][0].size == 1
    assert sharding.shards(docs.limit(0)).isEmpty()
    sharding.write_shards(docs.where("doc_id in (1, 2, 3)"), str(tmp_path / "s"), 2)
    assert spark.read.parquet(str(tmp_path / "s")).count() == 3


def test_exact_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    sql, query = driver.oracle_sql(), driver.queries()
    found = query["op1_cuckoo_exact_dedup"](spark, sf_dir)
    expected = con.sql(sql["op1_cuckoo_exact_dedup"])
    names = sorted(expected.columns)
    assert sorted(found.columns) == names
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(
        con.sql(f"SELECT {', '.join(names)} FROM expected").fetchall()
    )


def test_pipeline_stages(spark, sf_dir, tmp_path):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        sizes.append(docs.count())
        assert docs.columns == columns or k == len(cp.STAGES) - 1
    assert sizes[0] >= sizes[1] > sizes[2] >= sizes[3] and sizes[5] == sizes[4]
    assert len(cp.STAGES) == 5 and {f"op{n}" for n in range(1, 14)} == {
        name.split("_")[0] for name in driver.queries() if name.startswith("op")
    }
