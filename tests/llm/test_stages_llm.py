"""The pipeline's stages on odd rows: nulls, repeats, empty tables, clashing column names."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fallscan.llm import exact_dedup, mixing, near_dedup, toxicity
from fallscan.llm.common import BATCH_BYTES, free_names, prepare

CLASHING = [
    "__bad", "__digest", "__gone_id", "__gone_digest", "__twice_id", "__twice_digest", "__gone",
    "__of", "__copies", "__COPY", "digest", "keep_id", "size", "score", "row_no", "component_id",
]
LONG = "one two three four five six seven eight nine ten " * 4_000
ROWS = [
    (1, "the same text in two rows"), (1, "the same text in two rows"), (2, "the same text  in two rows"),
    (3, None), (4, ""), (None, "no id at all"), (None, None), (5, LONG), (6, LONG), (7, "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(
        [(i, t, "en", "abc"[k % 3]) for k, (i, t) in enumerate(ROWS)],
        "doc_id long, text string, lang string, source string",
    )
    return rows.select("*", *[F.lit(f"my {name}").alias(name) for name in CLASHING])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")


def stages(labels):
    return {
        "toxicity": lambda rows: toxicity.accepted(rows, labels),
        "exact": exact_dedup.unique,
        "near": near_dedup.representatives,
        "mixture": mixing.mixed,
    }


@pytest.mark.parametrize("name", ["toxicity", "exact", "near", "mixture"])
def test_stage_keeps_columns_and_their_values(docs, labels, name):
    stage = stages(labels)[name]
    kept = stage(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert rows and all(r[c] == f"my {c}" for r in rows for c in CLASHING)
    assert stage(docs.limit(0)).isEmpty()


def test_what_the_stages_keep(docs, labels):
    found = {
        name: sorted((r.doc_id or 0, (r.text or "")[:3]) for r in stage(docs).collect())
        for name, stage in stages(labels).items() if name != "mixture"
    }
    assert len(found["toxicity"]) == len(ROWS)
    assert found["exact"] == [(0, "no "), (1, "the"), (3, ""), (5, "one"), (7, "x")]
    ids = [i for i, _ in found["near"]]
    assert 2 not in ids and 6 not in ids and {1, 3, 4, 5, 7} <= set(ids)


def test_free_names(spark):
    rows = spark.sql("select 1 as A, 2 as a_, 3 as b")
    assert free_names(rows, "a", "c", "B") == ["a__", "c", "B_"]


def test_batches_of_texts_are_bounded_by_their_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"]
            )

    prepare(spark)
    long = spark.range(0, 60, 1, 1).selectExpr("id", "repeat('x', 100000) as text")
    found = long.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(row["rows"] for row in found) == 60
    assert max(row["bytes"] for row in found) < BATCH_BYTES + 110_000
