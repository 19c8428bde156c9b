"""Import query keys bound to the test tables.

``part`` plays the database table ``products_replica``; the landing and
target folders live below the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import ingest
from shelfwise.session import scratch_path, unique_name
from shelfwise.sources.formats import convert, write_as
from shelfwise.sources.tables import Tables
from shelfwise.streaming.incremental import read_remembered, read_target, run_available_now, run_remembered

# Split points, separators and sentinels of the reference's
# import commands.  PART1_MAX, PART2_MIN and LAST_VALUE only divide the table
# between the two imports of a merge or an incremental run; the bounds of the
# bounded import are its feature.
PART1_MAX, PART2_MIN = 1111, 1000
LAST_VALUE = 1347
BOUNDED_MIN, BOUNDED_MAX = 1, 1000
IMPORT_TASKS = 3
STAR = "*"
PIPE = "|"
LINE_END = ";"

KEY_RANGES = 16

# Tables a full import copies: the stand-ins of the retail schema
# (departments, categories, products, customers, orders, order items).
IMPORT_ALL = ("region", "nation", "supplier", "part", "customer", "orders", "lineitem")


def ingest_table(spark: SparkSession, sf_dir: str, fmt: str = "parquet") -> DataFrame:
    """Import a whole table into snappy-compressed files of the given format."""
    part = Tables(spark, sf_dir).part
    return convert(part, scratch_path(spark, "import-part"), fmt, "snappy")


def ingest_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boundary query over the whole table: min and max key."""
    return ingest.key_bounds(Tables(spark, sf_dir).part, "p_partkey")


def ingest_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Import the keys from BOUNDED_MIN to BOUNDED_MAX as '|'-delimited text
    with sentinels -1 and 'NOT-AVAILABLE'; read back.  The bounds are filters
    of the scan and its splits are the import tasks; nothing is shuffled."""
    part = Tables(spark, sf_dir).part
    path = scratch_path(spark, "import-part-bounded")
    sliced = ingest.bounded_slice(part, "p_partkey", BOUNDED_MIN, BOUNDED_MAX)
    ingest.export_delimited(sliced, path, sep=PIPE, null_string="NOT-AVAILABLE", null_non_string=-1)
    return ingest.read_delimited(spark, path, part.schema, sep=PIPE)


def _with_gaps(part: DataFrame) -> DataFrame:
    """``part`` with missing values: no brand for the largest sizes and no
    size for the dearest parts, so both sentinel kinds are exercised."""
    return part.select(
        "p_partkey",
        "p_name",
        F.when(F.col("p_size") <= 40, F.col("p_brand")).alias("p_brand"),
        "p_type",
        F.when(F.col("p_retailprice") <= 990, F.col("p_size")).alias("p_size"),
        "p_retailprice",
    )


def ingest_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with null sentinels, '*' between fields and ';' after each row."""
    src = _with_gaps(Tables(spark, sf_dir).part)
    path = scratch_path(spark, "import-part-nulls")
    ingest.export_delimited(src, path, sep=STAR, null_string="NA", null_non_string=-1000, line_sep=LINE_END)
    return ingest.read_delimited(spark, path, src.schema, sep=STAR, line_sep=LINE_END)


# What a column adds to a table's content figure: (Spark SQL, DuckDB SQL) by type.
_CONTENT = {
    "int": ("cast({c} as bigint)", "cast({c} as bigint)"),
    "bigint": ("{c}", "{c}"),
    "string": ("cast(length({c}) as bigint)", "cast(length({c}) as bigint)"),
    "double": ("cast(round({c} * 100) as bigint)", "cast(round({c} * 100) as bigint)"),
    "timestamp_ntz": ("datediff({c}, date '1970-01-01')", "datediff('day', date '1970-01-01', cast({c} as date))"),
}

# Columns of the imported tables by type, for the oracle.
_IMPORTED = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "part": {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int", "p_retailprice": "double"},
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"},
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double",
        "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
    },
}


def _content(columns: dict[str, str], dialect: int) -> str:
    """Sum over all values of a table: a position-weighted sum, so swapped columns show."""
    terms = [f"{k + 1} * coalesce({_CONTENT[kind][dialect].format(c=c)}, 0)" for k, (c, kind) in enumerate(columns.items())]
    return f"cast(sum({' + '.join(terms)}) as bigint)"


def ingest_all_tables(spark: SparkSession, sf_dir: str, fmt: str = "parquet") -> DataFrame:
    """Import several tables with one codec; report rows and content per imported table."""
    t = Tables(spark, sf_dir)
    report = None
    for name in IMPORT_ALL:
        back = convert(t.load(name), scratch_path(spark, f"import-all-{name}"), fmt, "snappy")
        row = back.selectExpr(f"'{name}' as table_name", "*").groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rows"), F.expr(_content(dict(back.dtypes), 0)).alias("content"))
        report = row if report is None else report.unionByName(row)
    return report


def ingest_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full import again, tables side by side, each compared with its source row for row by hashes."""
    t = Tables(spark, sf_dir)
    return ingest.import_verified({name: t.load(name) for name in IMPORT_ALL}, lambda name: scratch_path(spark, f"import-verified-{name}"))


def _changed(part: DataFrame) -> DataFrame:
    return part.select(
        "p_partkey",
        F.concat(F.col("p_name"), F.lit(" v2")).alias("p_name"),
        "p_brand",
        "p_type",
        "p_size",
        (F.col("p_retailprice") + F.lit(1.0)).alias("p_retailprice"),
    )


def ingest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two imported parts ('*'-text), the second with changed rows, merged on
    the key into a new folder (newest wins)."""
    part = Tables(spark, sf_dir).part
    p1, p2 = scratch_path(spark, "import-part1"), scratch_path(spark, "import-part2")
    ingest.export_delimited(part.where(F.col("p_partkey") <= PART1_MAX), p1, sep=STAR,
                            null_string="NA", null_non_string=-1000)
    ingest.export_delimited(_changed(part.where(F.col("p_partkey") > PART2_MIN)), p2, sep=STAR,
                            null_string="NA", null_non_string=-1000)
    old = ingest.read_delimited(spark, p1, part.schema, sep=STAR)
    new = ingest.read_delimited(spark, p2, part.schema, sep=STAR)
    merged_path = scratch_path(spark, "import-part-merged")
    ingest.merge_by_key(old, new, "p_partkey").write.parquet(merged_path)
    return spark.read.parquet(merged_path)


def ingest_merge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge into a keyed catalog table, in place: ranges of the key
    that the second part does not reach keep their files."""
    part = Tables(spark, sf_dir).part
    name = ingest.create_keyed(part.where(F.col("p_partkey") <= PART1_MAX), unique_name("products_keyed"), "p_partkey", KEY_RANGES)
    ingest.merge_into_keyed(spark, name, _changed(part.where(F.col("p_partkey") > PART2_MIN)))
    return ingest.keyed_rows(spark, name)


def ingest_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Import the whole order lines by three tasks of equal work, split by a
    column whose values are few and repeated."""
    lineitem = Tables(spark, sf_dir).lineitem
    back = ingest.import_in_splits(lineitem, scratch_path(spark, "import-splits"), "l_quantity", IMPORT_TASKS, compression="snappy")
    return back.drop("split")


def ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Initial import up to a last value, then two incremental runs that
    append only keys above the target's current maximum."""
    part = Tables(spark, sf_dir).part
    target = scratch_path(spark, "import-incremental")
    part.where(F.col("p_partkey") <= LAST_VALUE).write.parquet(target)
    for _ in range(2):
        last = ingest.last_value(spark.read.parquet(target), "p_partkey")
        ingest.rows_after(part, "p_partkey", last).write.mode("append").parquet(target)
    return spark.read.parquet(target)


def ingest_incremental_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into a catalog table: created by the initial import, appended
    by two incremental runs."""
    part = Tables(spark, sf_dir).part
    target = unique_name("products_import")
    part.where(F.col("p_partkey") <= LAST_VALUE).write.saveAsTable(target)
    for _ in range(2):
        last = ingest.last_value(spark.table(target), "p_partkey")
        ingest.rows_after(part, "p_partkey", last).write.insertInto(target)
    return spark.table(target)


def ingest_incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two slices land one after another; a checkpointed availableNow stream
    runs after each, and once more with nothing new."""
    part = Tables(spark, sf_dir).part
    landing = scratch_path(spark, "landing")
    target = scratch_path(spark, "import-stream")
    checkpoint = scratch_path(spark, "import-stream-checkpoint")
    slices = [
        part.where(F.col("p_partkey") <= PART2_MIN),
        part.where(F.col("p_partkey") > PART2_MIN),
    ]
    for rows in slices:
        write_as(rows, landing, "parquet", "snappy", mode="append")
        run_available_now(spark, landing, part.schema, target, checkpoint)
    run_available_now(spark, landing, part.schema, target, checkpoint)
    return read_target(spark, target)


def ingest_remembered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved import job over a landing folder: the first slice lands, then lands
    again beside the second, and the job runs after each and once with nothing new."""
    part = Tables(spark, sf_dir).part
    landing, target, state = (scratch_path(spark, f"remembered-{k}") for k in ("landing", "target", "state"))
    first, second = part.where(F.col("p_partkey") <= PART2_MIN), part.where(F.col("p_partkey") > PART2_MIN)
    for slices in ([first], [first, second], []):
        for rows in slices:
            write_as(rows, landing, "parquet", "snappy", mode="append")
        run_remembered(spark.read.schema(part.schema).parquet(landing), target, state, "p_partkey")
    return read_remembered(spark, target, part.schema)


QUERIES = {
    "ingest_table": ingest_table,
    "ingest_bounds": ingest_bounds,
    "ingest_bounded": ingest_bounded,
    "ingest_nulls": ingest_nulls,
    "ingest_all_tables": ingest_all_tables,
    "ingest_verified": ingest_verified,
    "ingest_merge": ingest_merge,
    "ingest_merge_table": ingest_merge_table,
    "ingest_splits": ingest_splits,
    "ingest_incremental": ingest_incremental,
    "ingest_incremental_table": ingest_incremental_table,
    "ingest_incremental_stream": ingest_incremental_stream,
    "ingest_remembered": ingest_remembered,
}

_MERGED = """
        select * from part where p_partkey <= 1000
        union all
        select p_partkey, p_name || ' v2' as p_name, p_brand, p_type, p_size,
               p_retailprice + 1.0 as p_retailprice
        from part where p_partkey > 1000"""

ORACLE_SQL = {
    "ingest_table": "select * from part",
    "ingest_bounds": "select min(p_partkey) as min_key, max(p_partkey) as max_key from part",
    "ingest_bounded": f"select * from part where p_partkey between {BOUNDED_MIN} and {BOUNDED_MAX}",
    "ingest_nulls": """
        select p_partkey, p_name,
               coalesce(case when p_size <= 40 then p_brand end, 'NA') as p_brand,
               p_type,
               coalesce(case when p_retailprice <= 990 then p_size end, -1000) as p_size,
               p_retailprice
        from part""",
    "ingest_all_tables": " union all ".join(
        f"select '{name}' as table_name, count(*) as n_rows, {_content(_IMPORTED[name], 1)} as content from {name}" for name in IMPORT_ALL
    ),
    "ingest_verified": " union all ".join(f"select '{name}' as table_name, count(*) as n_rows, true as same from {name}" for name in IMPORT_ALL),
    "ingest_merge": _MERGED,
    "ingest_merge_table": _MERGED,
    "ingest_splits": "select * from lineitem",
    "ingest_incremental": "select * from part",
    "ingest_incremental_table": "select * from part",
    "ingest_incremental_stream": "select * from part",
    "ingest_remembered": "select * from part",
}
