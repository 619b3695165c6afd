"""The gold layer: batches, facts, rebuilds and increments, from small raw files."""

from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lodeworks.plans.arrivals import load_arrivals
from lodeworks.plans.reports import register_star, top_entities
from lodeworks.plans.specs import RESULTS_STAR
from lodeworks.plans.splice import read_facts
from lodeworks.plans.star import (
    ChangedEditionError,
    LateEditionError,
    load_batch,
    compact,
    load_editions,
    read_dimension,
    remove_superseded,
    run_pipeline,
)
from lodeworks.schemas import DIM_NOC, FACT_RESULTS
from lodeworks.operators.facts import multiset_difference
from lodeworks.operators.lineage import read_lineage
from lodeworks.sources.gold import Gold, Loads, Merged
from lodeworks.sources.tables import append_rows, staging_root
from tests.conftest import rows

HEADER = '"ID","Name","Sex","Age","Height","Weight","Team","NOC","Games","Year","Season","City","Sport","Event","Medal"'

EVENTS_2000 = [
    '1,"Ann ""Fast"" Ray","F",22,170,60," Reds ","AAA","2000 Summer",2000,"Summer","Here","Running","100m","Gold"',
    '1,"Ann ""Fast"" Ray","F",22,170,60,"Reds","AAA","2000 Summer",2000,"Summer","Here","Running","100m","Gold"',
    '2,"Bo\nDi","M",NA,180,NA,"Blues","BBB","2000 Summer",2000,"Summer","Here","Running","100m",NA',
    '3,"Cy Fox","M",30,175,70,"Blues","ZZZ","2000 Summer",2000,"Summer","Here","Rowing","Eight","Silver"',
]
EVENTS_2004 = [
    '1,"Ann ""Fast"" Ray","F",26,170,61,"Greens","AAA","2004 Summer",2004,"Summer","There","Running","100m","Bronze"',
    '3,"Cy Fox","M",34,175,70,"Blues","BBB","2004 Summer",2004,"Summer","There","Boats","Eight",NA',
    '4,"Di Gil","F",20,160,50,"Reds","AAA","2004 Summer",2004,"Summer","There","Boats","Eight","Gold"',
]
EVENTS_2004_WINTER = [
    '1,"Ann ""Fast"" Ray","F",26,170,61,"Reds","AAA","2004 Winter",2004,"Winter","Far","Skiing","Slope",NA',
]
REGIONS = '"NOC","region","notes"\n"AAA","Aland",\n"BBB","Bland","big"\n" BBB","Bland","big"\n'


def write_raw(root, events, regions=REGIONS):
    raw = root / "raw"
    raw.mkdir(parents=True, exist_ok=True)
    (raw / "athlete_events.csv").write_text("\n".join([HEADER, *events]) + "\n")
    (raw / "noc_regions.csv").write_text(regions)


def star_tables(gold):
    tables = {
        dim.table.removeprefix("dim_"): read_dimension(gold, dim) for dim in RESULTS_STAR.dimensions
    }
    return {**tables, "fact": gold.read_all("fact_results", FACT_RESULTS)}


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("full")
    write_raw(root, EVENTS_2000 + EVENTS_2004 + EVENTS_2004_WINTER)
    return run_pipeline(spark, str(root))


@pytest.fixture(scope="module")
def silver(spark, full):
    """The cleaned events up to an edition, and the regions."""
    root = full.path.removesuffix("/gold")
    events = spark.read.parquet(f"{root}/silver/athlete_events")
    regions = spark.read.parquet(f"{root}/silver/noc_regions")
    return lambda last: events.filter(F.col("games") <= last), regions


def test_versions_follow_the_editions(full):
    athlete = star_tables(full)["athlete"]
    assert rows(athlete.filter("athlete_nk = 1"), "athlete_sk", "team", "valid_from", "valid_to", "is_current") == [
        (1, "Reds", date(2000, 1, 1), date(2004, 1, 1), False),
        (4, "Greens", date(2004, 1, 1), date(2004, 1, 1), False),
        (6, "Reds", date(2004, 1, 1), date(9999, 12, 31), True),
    ]
    assert rows(athlete, "athlete_sk", "athlete_nk") == [(1, 1), (2, 2), (3, 3), (4, 1), (5, 4), (6, 1)]


def test_event_is_overwritten_and_game_is_not(full):
    tables = star_tables(full)
    assert rows(tables["event"], "event_sk", "event_name", "sport") == [
        (1, "100m", "Running"), (2, "Eight", "Boats"), (3, "Slope", "Skiing"),
    ]
    assert rows(tables["game"], "game_sk", "games", "year", "city") == [
        (1, "2000 Summer", 2000, "Here"), (2, "2004 Summer", 2004, "There"), (3, "2004 Winter", 2004, "Far"),
    ]
    assert tables["game"].schema["year"].dataType.typeName() == "integer"


def test_facts_keep_the_version_of_their_edition(full):
    tables = star_tables(full)
    facts = tables["fact"]
    assert facts.columns == FACT_RESULTS.names
    assert rows(facts.drop("result_sk")) == sorted([
        (1, 1, 1, 1, "Gold", 22.0, 170.0, 60.0),
        (2, 1, 2, 1, None, None, 180.0, None),
        (3, 2, None, 1, "Silver", 30.0, 175.0, 70.0),
        (4, 1, 1, 2, "Bronze", 26.0, 170.0, 61.0),
        (3, 2, 2, 2, None, 34.0, 175.0, 70.0),
        (5, 2, 1, 2, "Gold", 20.0, 160.0, 50.0),
        (6, 3, 1, 3, None, 26.0, 170.0, 61.0),
    ], key=repr)
    assert rows(facts.groupBy("game_sk").agg(F.array_sort(F.array_agg("result_sk")))) == [
        (1, [1, 2, 3]), (2, [4, 5, 6]), (3, [7]),
    ]


def test_quoted_and_multi_line_text_survives(full):
    athlete = star_tables(full)["athlete"]
    assert {row["name"] for row in athlete.filter("athlete_nk <= 2").collect()} == {'Ann "Fast" Ray', "Bo\nDi"}


def test_lineage_has_all_layers_and_unique_ids(spark, full):
    lineage = read_lineage(spark, full.lineage_path())
    ids = [row["lineage_id"] for row in lineage.orderBy("lineage_id").collect()]
    assert ids == list(range(1, 4 + 3 * 5 + 1))
    assert rows(lineage.filter("layer != 'gold'"), "layer", "target", "row_count") == [
        ("bronze", "bronze/athlete_events", 8), ("bronze", "bronze/noc_regions", 3),
        ("silver", "silver/athlete_events", 7), ("silver", "silver/noc_regions", 2),
    ]
    clock = datetime.now(timezone.utc).replace(tzinfo=None)
    assert all(abs(clock - row["run_timestamp"]) < timedelta(hours=1) for row in lineage.collect())
    third = lineage.filter("source = 'silver/athlete_events/2004 Summer'")
    assert rows(third, "target", "row_count") == [
        ("dim_athlete", 3), ("dim_event", 3), ("dim_game", 3), ("fact_results", 3),
    ]


def test_increment_equals_rebuild(spark, full, silver, tmp_path):
    events, regions = silver
    gold = Gold(spark, str(tmp_path))
    for last in ("2000 Summer", "2004 Summer", "2004 Winter"):
        assert load_editions(spark, events(last), regions, gold.path, incremental=True) == 1
    once = star_tables(full)
    for name, table in star_tables(gold).items():
        assert rows(table) == rows(once[name]), name
    # A load writes the versions that it opens or closes, the events that it adds or changes, and nothing else.
    third = spark.read.parquet(f"{gold.path}/dim_athlete/load=3")
    assert rows(third, "athlete_sk", F.col("is_current").cast("boolean")) == [(4, False), (6, True)]
    for name, keys in (("event", [(3,)]), ("game", [(3,)])):
        assert rows(spark.read.parquet(f"{gold.path}/dim_{name}/load=3"), f"{name}_sk") == keys
    assert rows(gold.read_merged(Merged("dim_noc", DIM_NOC, "noc_sk"), Loads(None, (), (3,)))) == []
    # Nothing new: nothing happens.
    assert load_editions(spark, events("2004 Winter"), regions, gold.path, incremental=True) == 0
    assert gold.last_load()["load_id"] == 3


def folders(gold):
    return {f"{path.parent.name}/{path.name}" for path in Path(gold.path).glob("*/load=*")}


def test_compaction_changes_no_table(spark, full, silver, tmp_path):
    events, regions = silver
    gold = Gold(spark, str(tmp_path))
    load_editions(spark, events("2000 Summer"), regions, gold.path, incremental=True)
    assert compact(gold) is None
    load_editions(spark, events("2004 Summer"), regions, gold.path, incremental=True)
    before = {name: rows(table) for name, table in star_tables(gold).items()}
    assert compact(gold) == 3
    assert compact(gold) is None
    assert {name: rows(table) for name, table in star_tables(gold).items()} == before
    old = folders(gold)
    removed = remove_superseded(gold)
    assert set(removed) == {f"dim_{name}/load={n}" for name in ("athlete", "event", "noc") for n in (1, 2)}
    assert folders(gold) == old - set(removed)
    assert {name: rows(table) for name, table in star_tables(gold).items()} == before
    # Later increments build on the compacted tables.
    load_editions(spark, events("2004 Winter"), regions, gold.path, incremental=True)
    for name, table in star_tables(full).items():
        assert rows(star_tables(gold)[name]) == rows(table), name
    # A rebuild starts anew; what came before it can go, and so can what a failed load has left.
    load_editions(spark, events("2000 Summer"), regions, gold.path)
    gold.write_snapshot("dim_game", star_tables(gold)["game"], 9)
    remove_superseded(gold)
    assert {name.split("=")[1] for name in folders(gold)} == {"5"}
    assert rows(star_tables(gold)["game"], "game_sk") == [(1,)]


def test_an_increment_without_changes_writes_no_dimension_row(spark, silver, tmp_path):
    events, regions = silver
    gold = Gold(spark, str(tmp_path))
    for _ in range(3):
        load_batch(spark, events("2004 Summer"), regions, gold.path, date(2010, 5, 1))
    assert gold.loads().merged == (1, 2, 3)
    for number in (2, 3):
        loads = Loads(None, (number,), (number,))
        for dim in RESULTS_STAR.dimensions:
            assert read_dimension(gold, dim, loads).isEmpty(), dim.table


def test_rebuild_replaces_and_late_editions_are_refused(spark, silver, tmp_path):
    events, regions = silver
    gold = Gold(spark, str(tmp_path))
    newest = events("2004 Summer").filter("games = '2004 Summer'")
    load_editions(spark, newest, regions, gold.path)
    with pytest.raises(LateEditionError):
        load_editions(spark, events("2004 Summer"), regions, gold.path, incremental=True)
    load_editions(spark, events("2000 Summer"), regions, gold.path)
    tables = star_tables(gold)
    assert rows(tables["game"], "game_sk", "games") == [(1, "2000 Summer")]
    assert tables["fact"].count() == 3
    # What an unfinished load has written is not visible.
    gold.write_snapshot("dim_game", tables["game"].withColumn("game_sk", F.lit(9)), 3)
    assert rows(star_tables(gold)["game"], "game_sk", "games") == [(1, "2000 Summer")]


def without_keys(gold):
    """Versions, overwritten rows and facts as they are, whatever surrogate keys they have."""
    tables = {dim.table: read_dimension(gold, dim) for dim in RESULTS_STAR.dimensions}
    facts = read_facts(gold, RESULTS_STAR.fact)
    assert facts.count() == facts.select("result_sk").distinct().count()
    seen = facts.drop("result_sk")
    for dim in RESULTS_STAR.dimensions:
        if dim.table != "dim_noc":  # dated by the first edition that was loaded
            assert tables[dim.table].count() == tables[dim.table].select(dim.surrogate_key).distinct().count()
            renamed = tables[dim.table].select(
                dim.surrogate_key, *(F.col(name).alias(f"{dim.table}_{name}") for name in dim.schema.names if name != dim.surrogate_key)
            )
            seen = seen.join(renamed, dim.surrogate_key, "left").drop(dim.surrogate_key)
    whole = [rows(tables[dim.table].drop(dim.surrogate_key)) for dim in RESULTS_STAR.dimensions if dim.table != "dim_noc"]
    return [*whole, rows(seen.drop("noc_sk"))]


@pytest.mark.parametrize("first", [["2000 Summer", "2004 Winter"], ["2004 Winter"]])
def test_late_editions_are_spliced_into_history(spark, full, silver, tmp_path, first):
    events, regions = silver
    gold = Gold(spark, str(tmp_path))
    load_editions(spark, events("2004 Winter").filter(F.col("games").isin(first)), regions, gold.path, True)
    before = rows(read_facts(gold, RESULTS_STAR.fact), "result_sk")
    every = events("2004 Winter")
    assert load_editions(spark, every, regions, gold.path, True, splice=True) == 3 - len(first)
    assert without_keys(gold) == without_keys(full)
    assert set(before) < set(rows(read_facts(gold, RESULTS_STAR.fact), "result_sk"))
    # Versions that go on from the same edition keep their keys, and facts are written again only if theirs changes.
    assert load_editions(spark, every, regions, gold.path, True, splice=True) == 0
    compact(gold)
    remove_superseded(gold)
    assert without_keys(gold) == without_keys(full)


def test_changed_editions_are_corrected(spark, full, silver, tmp_path):
    events, regions = silver
    every = events("2004 Winter")
    summer, own = F.col("games") == "2000 Summer", F.col("athlete_id")
    # A team that was wrong, a row that was missing, one that came twice, one too many, another measure.
    wrong = every.filter(~((F.col("games") == "2004 Summer") & (own == 4)))
    wrong = wrong.unionByName(every.filter(summer & (own == 2))).unionByName(every.filter(summer & (own == 2)).withColumn("athlete_id", F.lit(9)))
    wrong = wrong.withColumns({
        "team": F.when(summer & (own == 1), "Wrong").otherwise(F.col("team")),
        "weight": F.when(summer & (own == 3), 1.0).otherwise(F.col("weight")),
    })
    gold = Gold(spark, str(tmp_path))
    assert load_editions(spark, wrong, regions, gold.path, True) == 3
    before = read_facts(gold, RESULTS_STAR.fact)
    loaded, kept = before.count(), {r.result_sk for r in before.filter("weight = 61").collect()}
    with pytest.raises(ChangedEditionError):
        load_editions(spark, every, regions, gold.path, True)
    assert load_editions(spark, every, regions, gold.path, True, corrections=True) == 2
    assert without_keys(gold)[-1] == without_keys(full)[-1]
    facts = read_facts(gold, RESULTS_STAR.fact)
    after = {r.result_sk for r in facts.collect()}
    assert kept <= after and max(after) <= loaded + 4
    versions = read_dimension(gold, RESULTS_STAR.dimension("dim_athlete")).filter("athlete_nk <> 9").drop("athlete_sk")
    assert rows(versions) == rows(read_dimension(full, RESULTS_STAR.dimension("dim_athlete")).drop("athlete_sk"))
    gone = read_dimension(gold, RESULTS_STAR.dimension("dim_athlete")).filter("athlete_nk = 9").collect()
    assert [(v.is_current, v.valid_from == v.valid_to) for v in gone] == [(False, True)]
    # Nothing is left to do, and what was corrected can be corrected again, back to what it was.
    last = gold.last_load()["load_id"]
    assert load_editions(spark, every, regions, gold.path, True, corrections=True) == 0
    assert gold.last_load()["load_id"] == last
    assert load_editions(spark, wrong, regions, gold.path, True, corrections=True) == 2
    again = Gold(spark, str(tmp_path / "again"))
    load_editions(spark, wrong, regions, again.path)
    assert without_keys(gold)[-1] == without_keys(again)[-1]
    compact(gold)
    remove_superseded(gold)
    assert without_keys(gold)[-1] == without_keys(again)[-1]


def test_difference_of_rows_that_are_alike(spark):
    before = spark.createDataFrame([(k, "a" if k < 200 else None, 1.0, k % 3) for k in range(300)], "k long, s string, x double, g int")
    wanted = [("a", 1.0, 0)] * 150 + [(None, 1.0, 1)] * 40 + [("new", None, 7)] * 2
    after = spark.createDataFrame(wanted, "s string, x double, g int")
    added, taken = multiset_difference(before, after, "k", ["s", "x"], ["g"])
    assert rows(added) == [("new", None, 7)] * 2
    keys = [r.k for r in taken.collect()]
    assert len(set(keys)) == len(keys) == 110 and sum(k < 200 for k in keys) == 50
    added, taken = multiset_difference(before, before.limit(0), "k", ["s", "x"])
    assert added.isEmpty() and taken.count() == 300
    added, taken = multiset_difference(before.limit(0), before, "k", ["s", "x"])
    assert added.count() == 300 and taken.isEmpty()


def test_region_change_is_dated_by_the_new_edition(spark, silver, tmp_path):
    events, regions = silver
    gold = Gold(spark, str(tmp_path))
    load_editions(spark, events("2000 Summer"), regions, gold.path, incremental=True)
    renamed = regions.replace("Aland", "Eland", "region")
    load_editions(spark, events("2004 Summer"), renamed, gold.path, incremental=True)
    noc = star_tables(gold)["noc"]
    assert rows(noc.filter("noc_code = 'AAA'"), "noc_sk", "region", "valid_from", "valid_to", "is_current") == [
        (1, "Aland", date(2000, 1, 1), date(2004, 1, 1), False),
        (3, "Eland", date(2004, 1, 1), date(9999, 12, 31), True),
    ]
    facts = star_tables(gold)["fact"]
    assert rows(facts.filter("noc_sk in (1, 3)").groupBy("noc_sk").count()) == [(1, 1), (3, 2)]


def test_late_rows_of_a_loaded_edition_are_never_skipped(spark, silver, tmp_path):
    events, regions = silver
    gold = Gold(spark, str(tmp_path))
    part = events("2000 Summer").filter("athlete_id <> 3")
    load_editions(spark, part, regions, gold.path, incremental=True)
    with pytest.raises(ChangedEditionError, match="2000 Summer"):
        load_editions(spark, events("2000 Summer"), regions, gold.path, incremental=True)
    assert star_tables(gold)["fact"].count() == 2
    late = events("2000 Summer").filter("athlete_id = 3")
    load_batch(spark, late, regions, gold.path, date(2000, 1, 1))
    assert load_editions(spark, events("2004 Summer"), regions, gold.path, incremental=True) == 1
    assert sorted(row["result_sk"] for row in star_tables(gold)["fact"].collect()) == list(range(1, 7))


def test_region_changes_without_new_editions_are_loaded(spark, silver, tmp_path):
    events, regions = silver
    gold = Gold(spark, str(tmp_path))
    load_editions(spark, events("2000 Summer"), regions, gold.path, incremental=True)
    before = {name: rows(table) for name, table in star_tables(gold).items()}
    for name, day in (("Eland", None), ("Iland", date(2001, 3, 1)), ("Iland", date(2002, 1, 1))):
        renamed = regions.replace("Aland", name, "region")
        assert load_editions(spark, events("2000 Summer"), renamed, gold.path, True, region_date=day) == 0
    tables = star_tables(gold)
    assert rows(tables["noc"].filter("noc_code = 'AAA'"), "noc_sk", "region", "valid_from", "valid_to") == [
        (1, "Aland", date(2000, 1, 1), date(2000, 1, 1)),
        (3, "Eland", date(2000, 1, 1), date(2001, 3, 1)),
        (4, "Iland", date(2001, 3, 1), date(9999, 12, 31)),
    ]
    assert gold.last_load()["load_id"] == 3
    for name in ("athlete", "event", "game", "fact"):
        assert rows(tables[name]) == before[name], name


def test_label_decides_between_editions_of_one_year(spark, silver, tmp_path):
    events, regions = silver
    gold = Gold(spark, str(tmp_path))
    load_editions(spark, events("2000 Summer"), regions, gold.path, incremental=True)
    autumn = events("2000 Summer").withColumn("games", F.lit("2000 Autumn"))
    with pytest.raises(LateEditionError):
        load_editions(spark, events("2000 Summer").union(autumn), regions, gold.path, incremental=True)


def test_load_batch_takes_a_mixed_slice_as_one_batch(spark, silver, tmp_path):
    events, regions = silver
    gold = Gold(spark, str(tmp_path))
    for _ in range(2):
        load_batch(spark, events("2004 Summer"), regions, gold.path, date(2010, 5, 1))
    tables = star_tables(gold)
    assert tables["game"].count() == 2
    assert tables["athlete"].count() == 4  # one version each: a batch keeps one row per athlete
    assert {row["valid_from"] for row in tables["athlete"].collect()} == {date(2010, 5, 1)}
    # Loading a batch again appends its facts again and changes no dimension.
    assert sorted(row["result_sk"] for row in tables["fact"].collect()) == list(range(1, 13))
    assert read_lineage(spark, gold.lineage_path()).count() == 10


def test_null_dimension_key_fails_the_load(spark, silver, tmp_path):
    events, regions = silver
    broken = events("2000 Summer").withColumn("athlete_id", F.lit(None).cast("bigint"))
    with pytest.raises(Exception, match="null natural key"):
        load_editions(spark, broken, regions, str(tmp_path))
    assert Gold(spark, str(tmp_path)).last_load() is None


def test_leaderboard_and_sql_views(spark, full):
    tables = star_tables(full)
    top = top_entities(tables["fact"], tables["athlete"], "athlete_sk", "medal", ["name", "team"])
    assert [tuple(row) for row in top.collect()] == [("Cy Fox", "Blues", 1), ("Di Gil", "Reds", 1)]
    career = top_entities(
        tables["fact"], tables["athlete"], "athlete_sk", "medal", ["athlete_nk"], only_current=False
    )
    assert [tuple(row) for row in career.collect()] == [(1, 2), (3, 1), (4, 1)]
    register_star(spark, full.path)
    found = spark.sql(
        "SELECT a.name, a.team, count(*) AS medals FROM fact_results f "
        "JOIN dim_athlete a ON a.athlete_sk = f.athlete_sk "
        "WHERE f.medal IS NOT NULL AND a.is_current GROUP BY a.name, a.team"
    )
    assert rows(found) == rows(top)
    assert spark.sql("SELECT count(*) FROM pipeline_lineage").first()[0] == 19
    assert RESULTS_STAR.dimension("dim_noc").natural_key == "noc_code"


def test_loads_free_what_they_staged(spark, tmp_path):
    write_raw(tmp_path, EVENTS_2000)
    before = set(staged_files(spark))
    gold = run_pipeline(spark, str(tmp_path))
    write_raw(tmp_path, EVENTS_2000 + EVENTS_2004)
    run_pipeline(spark, str(tmp_path), incremental=True)
    silver = [spark.read.parquet(f"{tmp_path}/silver/{name}") for name in ("athlete_events", "noc_regions")]
    load_batch(spark, *silver, gold.path, date(2005, 1, 1))
    write_raw(tmp_path, EVENTS_2000[1:3])
    with pytest.raises(ChangedEditionError):
        run_pipeline(spark, str(tmp_path), incremental=True)
    assert set(staged_files(spark)) == before


def staged_files(spark):
    return Path(staging_root(spark)).rglob("*.parquet")


def test_no_load_is_published_without_lineage(spark, tmp_path, monkeypatch):
    write_raw(tmp_path, EVENTS_2000)

    def fail(*_):
        raise OSError

    monkeypatch.setattr("lodeworks.plans.star._log_editions", fail)
    with pytest.raises(OSError):
        run_pipeline(spark, str(tmp_path))
    assert Gold(spark, f"{tmp_path}/gold").last_load() is None


def test_arrivals_load_only_new_files(spark, silver, tmp_path, monkeypatch):
    events, regions = silver
    every, late = events("2004 Winter"), (F.col("games") == "2000 Summer") & (F.col("athlete_id") == 3)
    gold, drops = Gold(spark, str(tmp_path / "gold")), str(tmp_path / "drops")

    def run():
        return load_arrivals(spark, drops, every.schema, regions, gold.path, str(tmp_path / "seen"), splice=True)

    append_rows(every.filter((F.col("games") == "2000 Summer") & ~late), drops)
    assert run() == 2
    append_rows(every.filter("games = '2004 Winter'"), drops)
    # A run that fails before it publishes loads nothing; the next one takes the same files.
    with monkeypatch.context() as patched, pytest.raises(Exception, match="no disk"):
        patched.setattr(Gold, "publish", lambda *_, **__: (_ for _ in ()).throw(OSError("no disk")))
        run()
    assert gold.last_load()["load_id"] == 1
    assert run() == 1
    assert run() == 0
    # An edition between the loaded ones, and more rows of one that is loaded.
    append_rows(every.filter((F.col("games") == "2004 Summer") | late), drops)
    assert run() == 4
    facts = read_facts(gold, RESULTS_STAR.fact)
    assert sorted(row["result_sk"] for row in facts.collect()) == list(range(1, 8))
    games = read_dimension(gold, RESULTS_STAR.dimension("dim_game"))
    assert rows(facts.join(games, "game_sk").groupBy("games").count()) == [
        ("2000 Summer", 3), ("2004 Summer", 3), ("2004 Winter", 1),
    ]
    assert gold.has_arrival(f"{tmp_path / 'seen'}#2") and not gold.has_arrival("other")
