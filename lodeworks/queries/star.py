"""A star schema over the supplied tables: sales lines by customer, part, nation and order year."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from lodeworks.operators.facts import Lookup, resolve_keys
from lodeworks.operators.lineage import read_lineage
from lodeworks.plans.arrivals import load_arrivals
from lodeworks.plans.reports import register_star, top_entities
from lodeworks.plans.specs import RESULTS_STAR, DimensionSpec, FactSpec, StarSpec
from lodeworks.plans.splice import read_facts
from lodeworks.plans.star import (
    ChangedEditionError,
    compact,
    dimension_snapshots,
    list_editions,
    load_batch,
    load_dimension,
    load_editions,
    read_dimension,
    remove_superseded,
    run_pipeline,
)
from lodeworks.queries.tables import (
    JAN_FIRST_SQL,
    SPLIT_YEAR,
    dates_as_text,
    table,
    versions_columns_sql,
    versions_sql,
)
from lodeworks.schemas import table_schema
from lodeworks.sources.gold import Gold
from lodeworks.sources.tables import append_rows, stage, staging_path

_LINE = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
_VERSION_TYPES = {"valid_from": "date", "valid_to": "date", "is_current": "boolean"}

SALES_STAR = StarSpec(
    edition="edition",
    year="order_year",
    edition_dimension="dim_edition",
    dimensions=(
        DimensionSpec(
            table="dim_edition",
            schema=table_schema(
                {"edition_sk": "long", "edition": "string", "order_year": "integer",
                 "opening_priority": "string"},
                ("edition_sk", "edition", "order_year"),
            ),
            scd_type=0,
            surrogate_key="edition_sk",
            columns={"edition": "edition", "order_year": "order_year",
                     "o_orderpriority": "opening_priority"},
            order=("o_orderdate", "o_orderkey"),
        ),
        DimensionSpec(
            table="dim_part",
            schema=table_schema(
                {"part_sk": "long", "part_nk": "long", "line_status": "string",
                 "return_flag": "string"},
                ("part_sk", "part_nk"),
            ),
            scd_type=1,
            surrogate_key="part_sk",
            columns={"l_partkey": "part_nk", "l_linestatus": "line_status",
                     "return_flag": "return_flag"},
            tracked=("line_status", "return_flag"),
            order=("o_orderdate", *_LINE),
        ),
        DimensionSpec(
            table="dim_customer",
            schema=table_schema(
                {"customer_sk": "long", "customer_nk": "long", "priority": "string",
                 "status": "string", **_VERSION_TYPES},
                ("customer_sk", "customer_nk", *_VERSION_TYPES),
            ),
            scd_type=2,
            surrogate_key="customer_sk",
            columns={"o_custkey": "customer_nk", "o_orderpriority": "priority",
                     "o_orderstatus": "status"},
            tracked=("priority", "status"),
            order=("o_orderdate", "o_orderkey"),
        ),
        DimensionSpec(
            table="dim_nation",
            schema=table_schema(
                {"nation_sk": "long", "nation_nk": "long", "nation": "string", "region": "string",
                 **_VERSION_TYPES},
                ("nation_sk", "nation_nk", *_VERSION_TYPES),
            ),
            scd_type=2,
            surrogate_key="nation_sk",
            columns={"nationkey": "nation_nk", "n_name": "nation", "r_name": "region"},
            tracked=("nation", "region"),
            source="regions",
        ),
    ),
    fact=FactSpec(
        table="fact_sales",
        schema=table_schema(
            {"sales_sk": "long", "customer_sk": "long", "part_sk": "long", "nation_sk": "long",
             "edition_sk": "long", "flag": "string", "quantity": "double", "price": "double",
             "discount": "double"},
            ("sales_sk",),
        ),
        surrogate_key="sales_sk",
        measures={"return_flag": "flag", "l_quantity": "quantity", "l_extendedprice": "price",
                  "l_discount": "discount"},
        partition_by=("edition_sk",),
    ),
)
ORDERED_STAR = replace(
    SALES_STAR, fact=replace(SALES_STAR.fact, order=("o_orderdate", *_LINE))
)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver events: one row per order line, with its order and the nation of its customer.

    Customers are joined to orders, not to the lines, which are shuffled once however many customers there are.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").drop("o_totalprice")
    nations = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("bigint").alias("nationkey")
    )
    year = F.year("o_orderdate").cast("bigint")
    others = [name for name in orders.columns if name != "o_custkey"]
    placed = orders.join(nations, "o_custkey")
    return (
        lines.join(placed, lines["l_orderkey"] == placed["o_orderkey"])
        .select("o_custkey", *lines.columns, *others, "nationkey")
        .withColumns(
            {
                "order_year": year,
                "edition": F.concat(year.cast("string"), F.lit(" Orders")),
                "return_flag": F.nullif("l_returnflag", F.lit("N")),
            }
        )
    )


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver regions."""
    regions = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return table(spark, sf_dir, "nation").join(regions, "n_regionkey").select(
        F.col("n_nationkey").cast("bigint").alias("nationkey"), "n_name", "r_name"
    )


def _numbered(
    spark: SparkSession, sf_dir: str, dim: DimensionSpec, also: tuple[str, ...] = ()
) -> DataFrame:
    """The columns a dimension needs, with the batch number and load date of their edition."""
    needed = dict.fromkeys([SALES_STAR.edition, SALES_STAR.year, *dim.columns, *dim.order, *also])
    events = stage(sales(spark, sf_dir).select(*needed), "sales")
    editions = list_editions(events, SALES_STAR)
    return events.join(editions.select("edition", "edition_seq", "load_date"), "edition")


def _dimension(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    dim = SALES_STAR.dimension(name)
    snapshots = dimension_snapshots(_numbered(spark, sf_dir, dim), dim)
    return dates_as_text(load_dimension(snapshots, dim)[0].select(dim.schema.names))


def dim_edition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dimension(spark, sf_dir, "dim_edition")


def dim_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dimension(spark, sf_dir, "dim_part")


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dimension(spark, sf_dir, "dim_customer")


def dim_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations of a loaded star, read back from gold."""
    return _read_back(_loaded(spark, sf_dir), "dim_nation")


def _read_back(gold: Gold, name: str) -> DataFrame:
    return dates_as_text(read_dimension(gold, SALES_STAR.dimension(name)))


def _loaded(
    spark: SparkSession, sf_dir: str, spec: StarSpec = SALES_STAR, events: DataFrame | None = None
) -> Gold:
    gold = Gold(spark, staging_path(spark, "gold"))
    if events is None:
        events = stage(sales(spark, sf_dir), "sales")
    load_editions(
        spark, events, nations(spark, sf_dir), gold.path, spec=spec, source_names=("sales", "nations")
    )
    return gold


def _facts(gold: Gold) -> DataFrame:
    return read_facts(gold, SALES_STAR.fact)


def fact_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All facts; their numbers within a year have no meaning, so fact_key_ranges checks those."""
    return _facts(_loaded(spark, sf_dir)).drop("sales_sk")


def fact_key_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of each year are dense and follow those of the year before."""
    return _facts(_loaded(spark, sf_dir)).groupBy("edition_sk").agg(
        F.min("sales_sk").alias("first_sk"),
        F.max("sales_sk").alias("last_sk"),
        F.countDistinct("sales_sk").alias("n_keys"),
    )


def fact_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All facts, numbered in a declared order within each year."""
    return _facts(_loaded(spark, sf_dir, ORDERED_STAR))


def _by_edition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales as a silver table partitioned by edition, of which an increment reads the editions that it loads."""
    return stage(sales(spark, sf_dir), "sales", [SALES_STAR.edition])


def _incremented(spark: SparkSession, sf_dir: str) -> Gold:
    """The years before the split first, then everything: the loaded years are skipped."""
    gold = Gold(spark, staging_path(spark, "gold"))
    events = _by_edition(spark, sf_dir)
    for part in (events.filter(F.col("order_year") < SPLIT_YEAR), events):
        load_editions(spark, part, nations(spark, sf_dir), gold.path, True, SALES_STAR)
    return gold


def _streamed(spark: SparkSession, sf_dir: str) -> Gold:
    """Sales arrive as files in three drops, by years; each run loads the new files."""
    gold, root = Gold(spark, staging_path(spark, "gold")), staging_path(spark, "arrivals")
    events, places = stage(sales(spark, sf_dir), "sales"), nations(spark, sf_dir)
    year = F.col("order_year")
    for drop in (year < SPLIT_YEAR - 1, year.between(SPLIT_YEAR - 1, SPLIT_YEAR), year > SPLIT_YEAR):
        append_rows(events.filter(drop), f"{root}/sales")
        load_arrivals(
            spark, f"{root}/sales", events.schema, places, gold.path, f"{root}/seen", SALES_STAR, ("sales", "nations")
        )
    return gold


def stream_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(_streamed(spark, sf_dir)).drop("sales_sk")


def fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(_incremented(spark, sf_dir)).drop("sales_sk")


def dim_customer_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A type 2 dimension after two increments equals that of one load of all years."""
    return _read_back(_incremented(spark, sf_dir), "dim_customer")


def dim_part_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A type 1 dimension after two increments equals that of one load of all years."""
    return _read_back(_incremented(spark, sf_dir), "dim_part")


def _compacted(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A dimension after three increments, before and after its deltas are compacted and the old ones removed."""
    gold = Gold(spark, staging_path(spark, "gold"))
    events, places = _by_edition(spark, sf_dir), nations(spark, sf_dir)
    for last in (SPLIT_YEAR - 1, SPLIT_YEAR, 9999):
        load_editions(spark, events.filter(F.col("order_year") <= last), places, gold.path, True, SALES_STAR)
    before = stage(_read_back(gold, name).withColumn("state", F.lit("before")), "before")
    compact(gold, SALES_STAR)
    remove_superseded(gold, SALES_STAR)
    return before.unionByName(_read_back(gold, name).withColumn("state", F.lit("after")))


def dim_customer_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compacted(spark, sf_dir, "dim_customer")


def dim_part_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compacted(spark, sf_dir, "dim_part")


def increment_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some lines of loaded years come late: the increment refuses them, a batch adds them, then nothing is left to do."""
    gold = Gold(spark, staging_path(spark, "gold"))
    events, places = stage(sales(spark, sf_dir), "sales"), nations(spark, sf_dir)
    late = F.col("l_linenumber") == 1
    load_editions(spark, events.filter(~late), places, gold.path, True, SALES_STAR)
    try:
        load_editions(spark, events, places, gold.path, True, SALES_STAR)
    except ChangedEditionError:
        load_batch(spark, events.filter(late), places, gold.path, date(2002, 1, 1), SALES_STAR)
    load_editions(spark, events, places, gold.path, True, SALES_STAR)
    editions = read_dimension(gold, SALES_STAR.dimension("dim_edition")).select("edition_sk", "edition")
    # Nearly every key is one line, so nothing is combined before the shuffle that both steps of the count share.
    facts = _facts(gold).select("edition_sk", "sales_sk").repartition("edition_sk", "sales_sk")
    counted = facts.groupBy("edition_sk").agg(
        F.count(F.lit(1)).alias("n_lines"), F.countDistinct("sales_sk").alias("n_keys")
    )
    return counted.join(editions, "edition_sk").select("edition", "n_lines", "n_keys")


def _spliced(spark: SparkSession, sf_dir: str) -> Gold:
    """Some years first, then all: the first year and one in between are spliced in, the last is added."""
    gold = Gold(spark, staging_path(spark, "gold"))
    events, places = _by_edition(spark, sf_dir), nations(spark, sf_dir)
    late = F.col("order_year").isin(1995, SPLIT_YEAR, 2001)
    load_editions(spark, events.filter(~late), places, gold.path, True, SALES_STAR)
    load_editions(spark, events, places, gold.path, True, SALES_STAR, splice=True)
    return gold


def _together(facts: DataFrame, by: list[str]) -> GroupedData:
    """Facts grouped *by* columns of their dimensions.

    Nearly every group is one line, so nothing is combined before a shuffle: the lines of a customer and part are
    brought together once, for both steps of a distinct count.
    """
    measures = [name for name in ("sales_sk", "price") if name in facts.columns]
    return facts.select(*by, *measures).repartition("customer_nk", "part_nk").groupBy(*by)


def increment_late_edition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which customer version and part the lines of each year point to, after late years: as in a rebuild."""
    gold = _spliced(spark, sf_dir)
    facts = _facts(gold).select("edition_sk", "customer_sk", "part_sk", "sales_sk")
    for name in ("dim_edition", "dim_customer", "dim_part"):
        dim = SALES_STAR.dimension(name)
        facts = facts.join(read_dimension(gold, dim), dim.surrogate_key)
    by = ["edition", "customer_nk", "priority", "status", "valid_from", "valid_to", "is_current",
          "part_nk", "line_status", "return_flag"]
    counted = _together(facts, by).agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("sales_sk").alias("n_keys"))
    return dates_as_text(counted)


def _corrected(spark: SparkSession, sf_dir: str) -> Gold:
    """Two years are loaded with lines missing, lines doubled, other prices and other priorities, then as they are."""
    gold = Gold(spark, staging_path(spark, "gold"))
    events, places = _by_edition(spark, sf_dir), nations(spark, sf_dir)
    changed, line = F.col("order_year").isin(1995, SPLIT_YEAR), F.col("l_linenumber")
    wrong = events.filter(~(changed & (line == 1)))
    wrong = wrong.unionByName(events.filter(changed & (line == 2)))
    wrong = wrong.withColumns({
        "l_extendedprice": F.when(changed & (line == 3), F.col("l_extendedprice") + 1).otherwise(F.col("l_extendedprice")),
        "o_orderpriority": F.when(changed & (F.col("o_orderpriority") == "1-URGENT"), "0-WRONG").otherwise(F.col("o_orderpriority")),
    })
    load_editions(spark, stage(wrong, "wrong-sales"), places, gold.path, True, SALES_STAR)
    load_editions(spark, events, places, gold.path, True, SALES_STAR, corrections=True)
    return gold


def increment_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each year with their prices, customer versions and parts, after corrections: as in a rebuild."""
    gold = _corrected(spark, sf_dir)
    facts = _facts(gold)
    for name in ("dim_edition", "dim_customer", "dim_part", "dim_nation"):
        rows = read_dimension(gold, SALES_STAR.dimension(name))
        if name == "dim_nation":
            rows = rows.drop("valid_from", "valid_to", "is_current")
        facts = facts.join(rows, SALES_STAR.dimension(name).surrogate_key)
    by = ["edition", "customer_nk", "priority", "status", "valid_from", "valid_to", "is_current", "part_nk", "nation_nk"]
    counted = _together(facts, by).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_distinct("sales_sk").alias("n_keys"),
        F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("price"),
    )
    return dates_as_text(counted)


def dim_customer_late_edition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customer versions after late years; surrogate keys are other ones than in a rebuild, and unique."""
    versions = _read_back(_spliced(spark, sf_dir), "dim_customer")
    # Versions of a customer are brought together once, for both steps of the distinct count.
    return versions.repartition("customer_nk").groupBy(*(name for name in versions.columns if name != "customer_sk")).agg(
        F.count_distinct("customer_sk").alias("n_keys")
    )


def increment_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region is renamed while no year is new: its nations get new versions, from the given day."""
    events = stage(sales(spark, sf_dir), "sales")
    gold = _loaded(spark, sf_dir, events=events)
    renamed = nations(spark, sf_dir).replace("ASIA", "EAST", "r_name")
    load_editions(
        spark, events, renamed, gold.path, True, SALES_STAR, region_date=date(2003, 5, 1)
    )
    return _read_back(gold, "dim_nation")


def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales as one batch."""
    gold = Gold(spark, staging_path(spark, "gold"))
    events = stage(sales(spark, sf_dir), "sales")
    load_batch(spark, events, nations(spark, sf_dir), gold.path, date(2002, 1, 1), ORDERED_STAR)
    return _facts(gold)


def fact_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of nations that the dimension lacks keep their row, with a null key."""
    known = nations(spark, sf_dir).filter(F.col("r_name") != "ASIA").select(
        "nationkey", (F.col("nationkey") + 1).alias("nation_sk")
    )
    facts = resolve_keys(sales(spark, sf_dir), [Lookup(known, ("nationkey",))])
    return facts.groupBy("nationkey", F.col("nation_sk").isNull().alias("unmatched")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _flagged_sales(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Facts with the customer version of their year, and the customer dimension."""
    dim = SALES_STAR.dimension("dim_customer")
    events = _numbered(spark, sf_dir, dim, ("return_flag",))
    dimension, bindings = load_dimension(dimension_snapshots(events, dim), dim)
    keys = stage(
        bindings.withColumnRenamed("customer_nk", "o_custkey"), "bindings"
    )
    facts = resolve_keys(
        events.select("o_custkey", "edition_seq", "return_flag"),
        [Lookup(keys, ("o_custkey", "edition_seq"))],
    )
    return facts, dimension


def leaderboard_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines per customer version, current versions only: the ten largest."""
    facts, customers = _flagged_sales(spark, sf_dir)
    by = ["customer_nk", "priority", "status"]
    return top_entities(facts, customers, "customer_sk", "return_flag", by, "returns")


def leaderboard_career(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines per customer over all versions: the ten largest."""
    facts, customers = _flagged_sales(spark, sf_dir)
    return top_entities(
        facts, customers, "customer_sk", "return_flag", ["customer_nk"], "returns", 10, False
    )


def star_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_star(spark, _loaded(spark, sf_dir).path, SALES_STAR)
    return spark.sql(
        """
        SELECT e.edition, n.region, c.priority, count(*) AS n_lines,
               count(f.flag) AS n_flagged, sum(f.quantity) AS quantity
        FROM fact_sales f
        JOIN dim_edition e ON e.edition_sk = f.edition_sk
        JOIN dim_nation n ON n.nation_sk = f.nation_sk
        JOIN dim_customer c ON c.customer_sk = f.customer_sk
        GROUP BY e.edition, n.region, c.priority
        """
    )


def lineage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _loaded(spark, sf_dir)
    return read_lineage(spark, gold.lineage_path()).drop("run_timestamp")


def batch_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two batches log, the second without the lines of the first years."""
    gold = Gold(spark, staging_path(spark, "gold"))
    events, places = stage(sales(spark, sf_dir), "sales"), nations(spark, sf_dir)
    later = F.col("order_year") >= SPLIT_YEAR
    for day, part in ((date(2002, 1, 1), events.filter(~later)), (date(2003, 1, 1), events.filter(later))):
        load_batch(spark, part, places, gold.path, day, SALES_STAR, ("sales", "nations"))
    return read_lineage(spark, gold.lineage_path()).drop("run_timestamp")


def pipeline_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a whole run logs in its three layers."""
    lineage = read_lineage(spark, _raw_run(spark, sf_dir).lineage_path())
    return lineage.drop("run_timestamp")


def snapshot_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two published snapshots of a dimension and one unpublished: readers see the second."""
    gold = Gold(spark, staging_path(spark, "gold"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    for load_id, label in enumerate(("first", "second", "third"), start=1):
        gold.write_snapshot("dim_segment", customers.withColumn("label", F.lit(label)), load_id)
        if label != "third":
            gold.publish(load_id, load_id == 1, 0)
    schema = table_schema({"c_custkey": "long", "c_mktsegment": "string", "label": "string"}, ())
    return gold.read_latest("dim_segment", schema)


def _raw_run(spark: SparkSession, sf_dir: str) -> Gold:
    """The whole run over orders written as raw event files: every order twice, once with padding."""
    root = staging_path(spark, "run")
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey"
    )
    year, status = F.year("o_orderdate"), F.col("o_orderstatus")
    season = F.when(F.month("o_orderdate") <= 6, "Summer").otherwise("Winter")
    events = orders.select(
        F.col("o_custkey").alias("ID"),
        F.col("c_name").alias("Name"),
        F.when(status == "F", "F").otherwise("M").alias("Sex"),
        F.when(status == "P", "NA").otherwise(F.dayofyear("o_orderdate").cast("string")).alias("Age"),
        F.month("o_orderdate").alias("Height"),
        F.when(status == "O", "70.5").otherwise("NA").alias("Weight"),
        F.col("o_orderpriority").alias("Team"),
        F.concat(F.lit("N"), "c_nationkey").alias("NOC"),
        F.concat(year, F.lit(" "), season).alias("Games"),
        year.alias("Year"),
        season.alias("Season"),
        F.lit("Here").alias("City"),
        F.concat(F.lit("Sport "), status).alias("Sport"),
        F.col("c_mktsegment").alias("Event"),
        F.when(status == "F", "Gold").when(status == "O", "Silver").otherwise("NA").alias("Medal"),
    )
    padded = events.withColumn("Team", F.concat(F.lit(" "), "Team", F.lit("  ")))
    regions = nations(spark, sf_dir).filter(F.col("n_name") != "NATION_0").select(
        F.concat(F.lit("N"), "nationkey").alias("NOC"),
        F.col("r_name").alias("region"),
        F.lit(None).cast("string").alias("notes"),
    )
    # Spaces at the ends of a field belong to the data.
    options = {"header": True, "quoteAll": True, "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False}
    events.unionByName(padded).write.options(**options).csv(f"{root}/raw/athlete_events.csv")
    regions.write.options(**options).csv(f"{root}/raw/noc_regions.csv")
    return run_pipeline(spark, root)


def raw_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts of a whole run from raw files."""
    gold = _raw_run(spark, sf_dir)
    facts = gold.read_all(RESULTS_STAR.fact.table, RESULTS_STAR.fact.schema)
    return facts.withColumn("noc_sk", F.coalesce("noc_sk", F.lit(-1))).drop("result_sk")


_SALES_SQL = f"""
    SELECT o_custkey, o_orderpriority, o_orderstatus, o_orderdate, o_orderkey,
           CAST(year(o_orderdate) AS BIGINT) AS edition_seq, c_nationkey,
           nullif(l_returnflag, 'N') AS return_flag, {", ".join(_LINE)}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""

_CUSTOMER_SNAPSHOTS_SQL = """
    SELECT o_custkey AS customer_nk, o_orderpriority AS priority, o_orderstatus AS status, edition_seq
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, edition_seq
                                       ORDER BY o_orderdate, o_orderkey) AS rn FROM sales)
    WHERE rn = 1"""

_TRACKED = ["priority", "status"]
_VERSIONS_SQL = versions_sql(
    _CUSTOMER_SNAPSHOTS_SQL, "customer_nk", _TRACKED, "customer_sk", JAN_FIRST_SQL
)

_PARTS_SQL = f"""
    part_lines AS (
        SELECT l_partkey AS part_nk, l_linestatus AS line_status, return_flag, edition_seq,
               row_number() OVER (PARTITION BY l_partkey, edition_seq
                                  ORDER BY o_orderdate, {", ".join(_LINE)}) AS rn
        FROM sales),
    part_ends AS (
        SELECT *, row_number() OVER (PARTITION BY part_nk ORDER BY edition_seq) AS from_start,
               row_number() OVER (PARTITION BY part_nk ORDER BY edition_seq DESC) AS from_end
        FROM part_lines WHERE rn = 1),
    parts AS (
        SELECT CAST(row_number() OVER (ORDER BY a.edition_seq, a.part_nk) AS BIGINT) AS part_sk,
               a.part_nk, z.line_status, z.return_flag
        FROM part_ends a JOIN part_ends z
          ON a.part_nk = z.part_nk AND a.from_start = 1 AND z.from_end = 1)"""

_EDITIONS_SQL = """
    editions AS (
        SELECT CAST(row_number() OVER (ORDER BY edition_seq) AS BIGINT) AS edition_sk, edition_seq,
               CAST(edition_seq AS VARCHAR) || ' Orders' AS edition, opening_priority, n_lines
        FROM (SELECT edition_seq, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS opening_priority,
                     count(*) AS n_lines
              FROM sales GROUP BY edition_seq))"""

_BOUND_SQL = """
    o_custkey = v.customer_nk AND v.edition_seq <= s.edition_seq
    AND (v.next_seq IS NULL OR s.edition_seq < v.next_seq)"""

_FACTS_SQL = f"""
    WITH sales AS ({_SALES_SQL}), {_VERSIONS_SQL}, {_PARTS_SQL}, {_EDITIONS_SQL}
    SELECT CAST(row_number() OVER (ORDER BY s.edition_seq, s.o_orderdate, {", ".join("s." + c for c in _LINE)})
                AS BIGINT) AS sales_sk,
           v.customer_sk, p.part_sk, CAST(c_nationkey + 1 AS BIGINT) AS nation_sk, e.edition_sk,
           s.return_flag AS flag, l_quantity AS quantity, l_extendedprice AS price,
           l_discount AS discount
    FROM sales s JOIN versions v ON {_BOUND_SQL}
    JOIN parts p ON l_partkey = p.part_nk JOIN editions e ON s.edition_seq = e.edition_seq"""

_EVENTS_SQL = """
    events AS (
        SELECT DISTINCT o_custkey AS athlete_nk, c_name AS name,
               CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'M' END AS sex, o_orderpriority AS team,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(dayofyear(o_orderdate) AS DOUBLE) END AS age,
               CAST(month(o_orderdate) AS DOUBLE) AS height, CASE WHEN o_orderstatus = 'O' THEN 70.5::DOUBLE END AS weight,
               'N' || CAST(c_nationkey AS VARCHAR) AS noc, year(o_orderdate) AS year,
               CAST(year(o_orderdate) AS VARCHAR)
                   || CASE WHEN month(o_orderdate) <= 6 THEN ' Summer' ELSE ' Winter' END AS games,
               CASE WHEN month(o_orderdate) <= 6 THEN 'Summer' ELSE 'Winter' END AS season,
               'Sport ' || o_orderstatus AS sport, c_mktsegment AS event,
               CASE o_orderstatus WHEN 'F' THEN 'Gold' WHEN 'O' THEN 'Silver' END AS medal
        FROM orders JOIN customer ON o_custkey = c_custkey),
    games AS (
        SELECT games, CAST(row_number() OVER (ORDER BY year, games) AS BIGINT) AS edition_seq
        FROM (SELECT DISTINCT games, year FROM events)),
    numbered AS (SELECT * FROM events JOIN games USING (games)),
    event_starts AS (
        SELECT event, CAST(row_number() OVER (ORDER BY min(edition_seq), event) AS BIGINT) AS event_sk
        FROM numbered GROUP BY event),
    nocs AS (
        SELECT noc, CAST(row_number() OVER (ORDER BY noc) AS BIGINT) AS noc_sk
        FROM (SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS noc FROM nation WHERE n_name <> 'NATION_0'))"""

_ATHLETES_SQL = versions_sql(
    """SELECT athlete_nk, name, sex, team, edition_seq FROM (
           SELECT *, row_number() OVER (PARTITION BY athlete_nk, edition_seq
                                        ORDER BY name, sex, team) AS rn FROM numbered)
       WHERE rn = 1""",
    "athlete_nk",
    ["name", "sex", "team"],
    "athlete_sk",
    "DATE '2000-01-01'",
)

_BOTH_STATES = "SELECT * FROM ({}), (VALUES ('before'), ('after')) AS states(state)"

QUERIES = {
    "raw_to_gold": (
        raw_to_gold,
        f"""WITH {_EVENTS_SQL}, {_ATHLETES_SQL}
            SELECT v.athlete_sk, event_sk, coalesce(noc_sk, -1) AS noc_sk, s.edition_seq AS game_sk, medal, age, height, weight
            FROM numbered s JOIN versions v
              ON s.athlete_nk = v.athlete_nk AND v.edition_seq <= s.edition_seq
             AND (v.next_seq IS NULL OR s.edition_seq < v.next_seq)
            JOIN event_starts USING (event) LEFT JOIN nocs USING (noc)""",
    ),
    "dim_edition": (
        dim_edition,
        f"""WITH sales AS ({_SALES_SQL}), {_EDITIONS_SQL}
            SELECT edition_sk, edition, edition_seq AS order_year, opening_priority FROM editions""",
    ),
    "dim_part": (dim_part, f"WITH sales AS ({_SALES_SQL}), {_PARTS_SQL} SELECT * FROM parts"),
    "dim_customer": (
        dim_customer,
        f"""WITH sales AS ({_SALES_SQL}), {_VERSIONS_SQL}
            SELECT {versions_columns_sql("customer_nk", _TRACKED, "customer_sk")} FROM versions""",
    ),
    "dim_nation": (
        dim_nation,
        """SELECT CAST(row_number() OVER (ORDER BY n_nationkey) AS BIGINT) AS nation_sk,
                  CAST(n_nationkey AS BIGINT) AS nation_nk, n_name AS nation, r_name AS region,
                  (SELECT CAST(make_date(CAST(min(year(o_orderdate)) AS INTEGER), 1, 1) AS VARCHAR)
                   FROM orders) AS valid_from,
                  '9999-12-31' AS valid_to, true AS is_current
           FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
    "fact_history": (fact_history, f"SELECT * EXCLUDE (sales_sk) FROM ({_FACTS_SQL})"),
    "fact_incremental": (fact_incremental, f"SELECT * EXCLUDE (sales_sk) FROM ({_FACTS_SQL})"),
    "fact_ordered": (fact_ordered, _FACTS_SQL),
    "fact_key_ranges": (
        fact_key_ranges,
        f"""SELECT edition_sk, min(sales_sk) AS first_sk, max(sales_sk) AS last_sk,
                   count(DISTINCT sales_sk) AS n_keys
            FROM ({_FACTS_SQL}) GROUP BY edition_sk""",
    ),
    "fact_load": (
        fact_load,
        f"""WITH sales AS (SELECT *, CAST(edition_seq AS VARCHAR) AS label FROM ({_SALES_SQL}))
            SELECT CAST(row_number() OVER (ORDER BY o_orderdate, {", ".join(_LINE)}) AS BIGINT) AS sales_sk,
                   CAST(dense_rank() OVER (ORDER BY o_custkey) AS BIGINT) AS customer_sk,
                   CAST(dense_rank() OVER (ORDER BY l_partkey) AS BIGINT) AS part_sk,
                   CAST(c_nationkey + 1 AS BIGINT) AS nation_sk,
                   CAST(dense_rank() OVER (ORDER BY label) AS BIGINT) AS edition_sk,
                   return_flag AS flag, l_quantity AS quantity, l_extendedprice AS price,
                   l_discount AS discount
            FROM sales""",
    ),
    "fact_unmatched": (
        fact_unmatched,
        """SELECT CAST(c_nationkey AS BIGINT) AS nationkey, r_name = 'ASIA' AS unmatched, count(*) AS n
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
           JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
           GROUP BY ALL""",
    ),
    "leaderboard_current": (
        leaderboard_current,
        f"""WITH sales AS ({_SALES_SQL}), {_VERSIONS_SQL}
            SELECT v.customer_nk, v.priority, v.status, count(*) AS returns
            FROM sales s JOIN versions v ON {_BOUND_SQL}
            WHERE return_flag IS NOT NULL AND is_current
            GROUP BY v.customer_nk, v.priority, v.status
            ORDER BY returns DESC, v.customer_nk, v.priority, v.status LIMIT 10""",
    ),
    "leaderboard_career": (
        leaderboard_career,
        f"""WITH sales AS ({_SALES_SQL})
            SELECT o_custkey AS customer_nk, count(*) AS returns FROM sales
            WHERE return_flag IS NOT NULL
            GROUP BY o_custkey ORDER BY returns DESC, o_custkey LIMIT 10""",
    ),
    "star_sql": (
        star_sql,
        f"""WITH sales AS ({_SALES_SQL}), {_VERSIONS_SQL}
            SELECT CAST(s.edition_seq AS VARCHAR) || ' Orders' AS edition, r_name AS region, v.priority,
                   count(*) AS n_lines, count(s.return_flag) AS n_flagged, sum(l_quantity) AS quantity
            FROM sales s JOIN versions v ON {_BOUND_SQL}
            JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
            GROUP BY ALL""",
    ),
    "lineage_log": (
        lineage_log,
        f"""WITH sales AS ({_SALES_SQL}), {_EDITIONS_SQL},
            tables(step, target) AS (VALUES (1, 'dim_edition'), (2, 'dim_part'), (3, 'dim_customer'),
                                            (4, 'dim_nation'), (5, 'fact_sales'))
            SELECT CAST((edition_sk - 1) * 5 + step AS BIGINT) AS lineage_id, 'gold' AS layer,
                   CASE WHEN step = 4 THEN 'nations' ELSE 'sales/' || edition END AS source, target,
                   CASE WHEN step = 4 THEN (SELECT count(*) FROM nation) ELSE n_lines END AS row_count,
                   'success' AS status
            FROM editions JOIN tables ON true""",
    ),
    "snapshot_replace": (
        snapshot_replace,
        "SELECT c_custkey, c_mktsegment, 'second' AS label FROM customer",
    ),
}
QUERIES |= {
    "dim_customer_increments": (dim_customer_increments, QUERIES["dim_customer"][1]),
    "dim_part_increments": (dim_part_increments, QUERIES["dim_part"][1]),
    "stream_increments": (stream_increments, QUERIES["fact_history"][1]),
    "dim_customer_compacted": (dim_customer_compacted, _BOTH_STATES.format(QUERIES["dim_customer"][1])),
    "dim_part_compacted": (dim_part_compacted, _BOTH_STATES.format(QUERIES["dim_part"][1])),
    "increment_late_rows": (
        increment_late_rows,
        """SELECT CAST(year(o_orderdate) AS VARCHAR) || ' Orders' AS edition, count(*) AS n_lines, count(*) AS n_keys
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    ),
    "increment_late_edition": (
        increment_late_edition,
        f"""WITH sales AS ({_SALES_SQL}), {_VERSIONS_SQL}, {_PARTS_SQL}, {_EDITIONS_SQL}
            SELECT edition, customer_nk, priority, status, CAST(valid_from AS VARCHAR) AS valid_from,
                   CAST(valid_to AS VARCHAR) AS valid_to, is_current, part_nk, p.line_status, p.return_flag,
                   count(*) AS n_lines, count(*) AS n_keys
            FROM sales s JOIN versions v ON {_BOUND_SQL}
            JOIN parts p ON l_partkey = p.part_nk JOIN editions e ON s.edition_seq = e.edition_seq
            GROUP BY ALL""",
    ),
    "increment_corrections": (
        increment_corrections,
        f"""WITH sales AS ({_SALES_SQL}), {_VERSIONS_SQL}, {_EDITIONS_SQL}
            SELECT edition, customer_nk, priority, status, CAST(valid_from AS VARCHAR) AS valid_from,
                   CAST(valid_to AS VARCHAR) AS valid_to, is_current, l_partkey AS part_nk, CAST(c_nationkey AS BIGINT) AS nation_nk,
                   count(*) AS n_lines, count(*) AS n_keys,
                   CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
            FROM sales s JOIN versions v ON {_BOUND_SQL}
            JOIN editions e ON s.edition_seq = e.edition_seq
            GROUP BY ALL""",
    ),
    "dim_customer_late_edition": (
        dim_customer_late_edition,
        f"""WITH sales AS ({_SALES_SQL}), {_VERSIONS_SQL}
            SELECT * EXCLUDE (customer_sk), CAST(1 AS BIGINT) AS n_keys
            FROM (SELECT {versions_columns_sql("customer_nk", _TRACKED, "customer_sk")} FROM versions)""",
    ),
    "increment_regions": (
        increment_regions,
        """WITH listed AS (
               SELECT row_number() OVER (ORDER BY n_nationkey) AS sk, CAST(n_nationkey AS BIGINT) AS nk, n_name, r_name,
                      (SELECT CAST(make_date(CAST(min(year(o_orderdate)) AS INTEGER), 1, 1) AS VARCHAR)
                       FROM orders) AS first_day
               FROM nation JOIN region ON n_regionkey = r_regionkey)
           SELECT CAST(sk AS BIGINT) AS nation_sk, nk AS nation_nk, n_name AS nation, r_name AS region,
                  first_day AS valid_from, CASE WHEN r_name = 'ASIA' THEN '2003-05-01' ELSE '9999-12-31' END AS valid_to,
                  r_name <> 'ASIA' AS is_current
           FROM listed
           UNION ALL
           SELECT CAST((SELECT count(*) FROM nation) + row_number() OVER (ORDER BY nk) AS BIGINT), nk, n_name, 'EAST',
                  '2003-05-01', '9999-12-31', true
           FROM listed WHERE r_name = 'ASIA'""",
    ),
    "batch_lineage": (
        batch_lineage,
        f"""WITH sizes(batch, n_lines) AS (
                SELECT CASE WHEN year(o_orderdate) < {SPLIT_YEAR} THEN 0 ELSE 1 END, count(*)
                FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1),
            tables(step, target) AS (VALUES (1, 'dim_edition'), (2, 'dim_part'), (3, 'dim_customer'),
                                            (4, 'dim_nation'), (5, 'fact_sales'))
            SELECT CAST(batch * 5 + step AS BIGINT) AS lineage_id, 'gold' AS layer,
                   CASE WHEN step = 4 THEN 'nations' ELSE 'sales' END AS source, target,
                   CASE WHEN step = 4 THEN (SELECT count(*) FROM nation) ELSE n_lines END AS row_count,
                   'success' AS status
            FROM sizes JOIN tables ON true""",
    ),
    "pipeline_lineage": (
        pipeline_lineage,
        f"""WITH {_EVENTS_SQL},
            sizes AS (SELECT edition_seq, games, count(*) AS n FROM numbered GROUP BY ALL),
            tables(step, target) AS (VALUES (1, 'dim_game'), (2, 'dim_event'), (3, 'dim_athlete'),
                                            (4, 'dim_noc'), (5, 'fact_results')),
            counts AS (SELECT 2 * (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey) AS raw_events,
                              (SELECT count(*) FROM events) AS events, (SELECT count(*) FROM nocs) AS nocs)
            SELECT CAST(4 + (edition_seq - 1) * 5 + step AS BIGINT) AS lineage_id, 'gold' AS layer,
                   CASE WHEN step = 4 THEN 'silver/noc_regions' ELSE 'silver/athlete_events/' || games END AS source,
                   target, CASE WHEN step = 4 THEN nocs ELSE n END AS row_count, 'success' AS status
            FROM sizes JOIN tables ON true JOIN counts ON true
            UNION ALL SELECT 1, 'bronze', 'raw/athlete_events.csv', 'bronze/athlete_events', raw_events, 'success' FROM counts
            UNION ALL SELECT 2, 'silver', 'bronze/athlete_events', 'silver/athlete_events', events, 'success' FROM counts
            UNION ALL SELECT 3, 'bronze', 'raw/noc_regions.csv', 'bronze/noc_regions', nocs, 'success' FROM counts
            UNION ALL SELECT 4, 'silver', 'bronze/noc_regions', 'silver/noc_regions', nocs, 'success' FROM counts""",
    ),
}
