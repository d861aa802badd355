"""Writers: ordered tables, FASTA, tables split by class, record filters."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomseq.functions.text import six_digits


def write_tsv(df: DataFrame, path: str, columns: list[str], compression: str = "none") -> None:
    """Fixed columns in the given order, tab-separated with a header, null as empty and
    fractional numbers with six significant digits."""
    fractional = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    text = {c: six_digits(F.col(c)) if c in fractional else F.col(c).cast("string") for c in columns}
    rows = df.select(*[F.coalesce(t, F.lit("")).alias(c) for c, t in text.items()])
    rows.write.option("sep", "\t").option("header", True).option("emptyValue", "").option("compression", compression).csv(path)


def write_fasta(df: DataFrame, path: str, record_id: Column, description: Column, sequence: Column, width: int = 60) -> None:
    """>id description, then the sequence in lines of width letters."""
    wrapped = F.regexp_replace(sequence, f"(.{{{width}}})(?=.)", "$1\n")
    df.select(F.concat(F.lit(">"), record_id, F.lit(" "), description, F.lit("\n"), wrapped).alias("value")).write.text(path)


def write_by_class(df: DataFrame, path: str, column: str) -> None:
    df.write.partitionBy(column).parquet(path)


def kept_records(records: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """Records whose id is in a kept set."""
    return records.join(kept.select(key).distinct(), key, "left_semi")


def publish(df: DataFrame, path: str, key: list[str], **rules: Column) -> DataFrame:
    """Write df as Parquet to path only if no row breaks a rule, and read it back. The pass that
    writes, to a folder beside path, puts rows that break a rule apart, so there is no second
    scan; where there are none the folder of the others gets its name, else all is deleted and
    an error names the rules, how many rows break each and the first keys, read from the broken
    rows alone. A rule that is null for a row counts as broken. path must not exist yet."""
    spark = df.sparkSession
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    broken = {name: F.coalesce(rule, F.lit(True)) for name, rule in rules.items()}
    place = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    files = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(place(path)):
        raise ValueError(f"{path} exists")
    some = F.lit(False)
    for rule in broken.values():
        some = some | rule
    bad, good = (f"{staging}/__broken={side}" for side in ("true", "false"))
    try:
        df.withColumn("__broken", some).write.partitionBy("__broken").parquet(staging)
        if files.exists(place(bad)):
            rows = spark.read.schema(df.schema).parquet(bad)
            counts = rows.agg(*[F.count_if(rule).alias(name) for name, rule in broken.items()]).first().asDict()
            first = {k: [r[0] for r in rows.where(broken[k]).select(F.concat_ws(":", *key).alias("k")).orderBy("k").limit(5).collect()] for k, n in counts.items() if n}
            raise ValueError(f"not published, rules broken by rows: { {k: n for k, n in counts.items() if n} }; first keys: {first}")
        if not files.exists(place(good)):
            spark.createDataFrame([], df.schema).write.parquet(path)
        elif not files.rename(place(good), place(path)):
            raise OSError(f"cannot move {good} to {path}")
    finally:
        files.delete(place(staging), True)
    return spark.read.schema(df.schema).parquet(path)
