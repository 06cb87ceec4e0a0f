import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[1]}:{os.environ.get('PYTHONPATH', '')}"

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").config("spark.sql.codegen.wholeStage", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    """Folder of the smallest supplied tables."""
    return f"{DATA}/sf0.001"


class Tables:
    """A folder of tables made from the supplied ones, changed per test."""

    CLASHES = ("value", "id", "v", "s", "n", "bucket", "chunk", "at", "group", "rank", "count", "__salt", "__hot", "__k", "target", "piece", "record", "total")

    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def put(self, name, df):
        df.write.mode("overwrite").parquet(f"{self.root}/{name}.parquet")

    def changed(self, names, change):
        for n in names:
            self.put(n, change(self.spark.read.parquet(f"{DATA}/sf0.001/{n}.parquet")))
        return str(self.root)

    def empty(self, names):
        return self.changed(names, lambda df: df.limit(0))

    def all_null(self, names):
        """Each table with rows of nulls put to its own."""
        from pyspark.sql import functions as F

        def change(df):
            nulls = df.limit(3).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
            return df.unionByName(nulls)

        return self.changed(names, change)

    def one_null_each(self, names):
        """For every column, some rows in which only that column is null."""
        from pyspark.sql import functions as F

        def change(df):
            out = df
            for c in df.columns:
                out = out.unionByName(df.limit(2).withColumn(c, F.lit(None).cast(df.schema[c].dataType)))
            return out

        return self.changed(names, change)

    def clashing(self, names):
        from pyspark.sql import functions as F

        def change(df):
            for c in self.CLASHES:
                if c not in df.columns:
                    df = df.withColumn(c, F.lit("clash"))
            return df

        return self.changed(names, change)

    def repeated(self, names):
        return self.changed(names, lambda df: df.unionAll(df).unionAll(df.limit(5)))


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, tmp_path)


@pytest.fixture
def rows():
    def of(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return of
