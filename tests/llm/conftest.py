import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOC = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents frame from (doc_id, text) pairs, over several partitions."""
    def make(rows, parts=3):
        df = spark.createDataFrame([tuple(r) for r in rows], DOC)
        return df.repartition(parts) if rows else df

    return make


@pytest.fixture(scope="session")
def with_clashes():
    """The frame with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ["h", "run", "rn", "kept", "keep_id", "component_id", "blocks", "blocks_0", "of_0", "whole", "cut", "row",
             "taken", "mix_epoch", "mix_domain", "spans", "start", "length", "score", "label", "grp", "prints"]

    def add(df):
        return df.withColumns({n: F.lit("x") for n in names if n not in df.columns})

    return add
