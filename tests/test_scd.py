"""Slowly changing dimensions: the rules one by one, and whole histories against a plain fold."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lodeworks.operators.scd import (
    OPEN_END,
    as_of,
    as_of_sliced,
    classify_changes,
    scd0_history,
    scd0_merge,
    scd1_history,
    scd1_merge,
    scd2_history,
    scd2_merge,
    scd2_versions,
)
from tests.conftest import rows

D0, D1, D2 = date(2001, 3, 5), date(2003, 9, 17), date(2011, 6, 30)
TRACKED = ["name", "team"]


def incoming(spark, *people):
    return spark.createDataFrame(list(people), "nk bigint, name string, team string")


def merge(existing, batch, day):
    return scd2_merge(existing, batch, "nk", TRACKED, "sk", day)


def versions(df):
    return rows(df, "sk", "nk", "name", "team", "valid_from", "valid_to", "is_current")


# --- type 2 --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def first(spark):
    return merge(None, incoming(spark, (1, "Ann", "Reds"), (2, "Bo", "Blues")), D0)


def test_first_load_opens_every_key(first):
    assert versions(first) == [
        (1, 1, "Ann", "Reds", D0, OPEN_END, True), (2, 2, "Bo", "Blues", D0, OPEN_END, True),
    ]


def test_unchanged_rows_change_nothing(spark, first):
    again = merge(first, incoming(spark, (1, "Ann", "Reds"), (2, "Bo", "Blues")), D1)
    assert versions(again) == versions(first)


def test_change_expires_and_adds_before_new_keys(spark, first):
    batch = incoming(spark, (0, "Aa", "Reds"), (2, "Bob", "Blues"), (1, "Ann", "Reds"))
    assert versions(merge(first, batch, D1)) == [
        (1, 1, "Ann", "Reds", D0, OPEN_END, True),
        (2, 2, "Bo", "Blues", D0, D1, False),
        (3, 2, "Bob", "Blues", D1, OPEN_END, True),
        (4, 0, "Aa", "Reds", D1, OPEN_END, True),
    ]


def test_missing_keys_stay_open(spark, first):
    assert versions(merge(first, incoming(spark, (2, "Bo", "Blues")), D1)) == versions(first)


def test_three_batches_and_a_return_to_an_old_value(spark):
    table = None
    for day, name in ((D0, "Bo"), (D1, "Bob"), (D2, "Bo")):
        table = merge(table, incoming(spark, (2, name, "Blues")), day)
    assert versions(table) == [
        (1, 2, "Bo", "Blues", D0, D1, False),
        (2, 2, "Bob", "Blues", D1, D2, False),
        (3, 2, "Bo", "Blues", D2, OPEN_END, True),
    ]


def test_null_and_empty_are_the_same_and_the_first_stays(spark):
    table = merge(None, incoming(spark, (1, None, "Reds")), D0)
    table = merge(table, incoming(spark, (1, "", "Reds")), D1)
    assert versions(table) == [(1, 1, None, "Reds", D0, OPEN_END, True)]


def test_untracked_columns_ride_along(spark):
    batch = incoming(spark, (1, "Ann", "Reds")).withColumn("city", F.lit("Here"))
    table = scd2_merge(None, batch, "nk", ["name"], "sk", D0)
    table = scd2_merge(table, batch.withColumn("city", F.lit("There")), "nk", ["name"], "sk", D1)
    assert rows(table, "sk", "city") == [(1, "Here")]
    changed = batch.withColumns({"name": F.lit("Anna"), "city": F.lit("There")})
    table = scd2_merge(table, changed, "nk", ["name"], "sk", D2)
    assert rows(table, "sk", "name", "city") == [(1, "Ann", "Here"), (2, "Anna", "There")]


def test_key_with_only_closed_versions_stays_closed(spark, first):
    closed = first.withColumns(
        {"is_current": F.col("nk") != 2, "valid_to": F.when(F.col("nk") == 2, D1).otherwise(OPEN_END)}
    )
    table = merge(closed, incoming(spark, (2, "Bob", "Greens"), (3, "Cy", "Reds")), D2)
    assert rows(table, "sk", "nk", "is_current") == [(1, 1, True), (2, 2, False), (3, 3, True)]


def test_two_batches_on_one_day_make_an_empty_interval(spark):
    table = merge(None, incoming(spark, (1, "Ann", "Reds")), D0)
    table = merge(table, incoming(spark, (1, "Ann", "Blues")), D0)
    assert rows(table, "sk", "valid_from", "valid_to") == [(1, D0, D0), (2, D0, OPEN_END)]
    assert rows(as_of(table, D0), "sk") == [(2,)]


def test_intervals_are_half_open(spark, first):
    table = merge(first, incoming(spark, (2, "Bob", "Blues")), D1)
    assert rows(as_of(table, D1 - timedelta(days=1)).filter("nk = 2"), "name") == [("Bo",)]
    assert rows(as_of(table, D1).filter("nk = 2"), "name") == [("Bob",)]
    assert as_of(table, D0 - timedelta(days=1)).count() == 0


@pytest.mark.parametrize("broken", [[(1, "a", "b"), (1, "c", "d")], [(None, "a", "b")]])
def test_bad_natural_keys_fail(spark, first, broken):
    batch = incoming(spark, *broken)
    for existing in (None, first):
        with pytest.raises(Exception, match="natural key"):
            merge(existing, batch, D1).collect()
        with pytest.raises(Exception, match="natural key"):
            scd1_merge(existing, batch, "nk", TRACKED, "sk").collect()
    with pytest.raises(Exception, match="natural key"):
        scd0_merge(None, batch, "nk", "sk").collect()


def test_tracked_column_must_be_present(spark, first):
    with pytest.raises(ValueError, match="team"):
        merge(first, incoming(spark, (1, "Ann", "x")).drop("team"), D1)


# --- whole histories -----------------------------------------------------------------------------


def random_history(keys, batches, seed):
    """(nk, batch, name, team) with nulls, empty texts, returns to old values and gaps."""
    rng = random.Random(seed)
    choices = [None, "", "a", "b"]
    return [
        (nk, batch, rng.choice(choices), rng.choice(choices[1:3]))
        for nk in range(keys)
        for batch in range(1, batches + 1)
        if rng.random() < 0.7
    ]


# Batches two and three share a date.
DAYS = {1: date(2000, 1, 1), 2: date(2002, 1, 1), 3: date(2002, 1, 1), 4: date(2006, 1, 1), 5: date(2008, 1, 1)}


def folded(history):
    """Versions and bindings by a plain loop over batches and keys."""
    done, bound, open_rows = [], [], {}
    for batch, day in DAYS.items():
        arrivals = sorted(row for row in history if row[1] == batch)
        text = lambda row: [row[2] or "", row[3] or ""]
        changed = [r for r in arrivals if r[0] in open_rows and text(open_rows[r[0]]["row"]) != text(r)]
        unseen = [r for r in arrivals if r[0] not in open_rows]
        for row in changed:
            open_rows[row[0]]["to"] = day
        for row in changed + unseen:
            open_rows[row[0]] = {"sk": len(done) + 1, "row": row, "from": day, "to": None}
            done.append(open_rows[row[0]])
        bound += [(row[0], batch, open_rows[row[0]]["sk"]) for row in arrivals]
    table = [
        (v["sk"], v["row"][0], v["row"][2], v["row"][3], v["from"], v["to"] or OPEN_END, v["to"] is None)
        for v in done
    ]
    return sorted(table, key=repr), sorted(bound, key=repr)


@pytest.fixture(scope="module")
def history(spark):
    plain = random_history(400, len(DAYS), seed=11)
    data = [(nk, batch, DAYS[batch], name, team) for nk, batch, name, team in plain]
    return plain, spark.createDataFrame(
        data, "nk bigint, edition_seq int, load_date date, name string, team string"
    )


def test_history_equals_the_fold(history):
    plain, snapshots = history
    result = scd2_versions(snapshots.repartition(7), "nk", TRACKED, "sk")
    table, bound = folded(plain)
    assert versions(result.dimension) == table
    assert rows(result.bindings, "nk", "edition_seq", "sk") == bound


def test_history_equals_repeated_merges(history):
    _, snapshots = history
    table = None
    for batch, day in DAYS.items():
        slice_ = snapshots.filter(F.col("edition_seq") == batch).select("nk", *TRACKED)
        table = merge(table, slice_, day)
    assert versions(table) == versions(scd2_history(snapshots, "nk", TRACKED, "sk"))


def test_history_on_top_of_history(history):
    plain, snapshots = history
    early = scd2_history(snapshots.filter("edition_seq <= 2"), "nk", TRACKED, "sk")
    table, bound = folded(plain)
    rest = snapshots.filter("edition_seq > 2")
    unmarked = scd2_versions(rest, "nk", TRACKED, "sk", early, always_open=True, bind=False)
    assert versions(unmarked.dimension) == table
    late = scd2_versions(rest, "nk", TRACKED, "sk", early)
    assert versions(late.dimension) == table
    assert rows(late.bindings, "nk", "edition_seq", "sk") == [b for b in bound if b[1] > 2]


def test_history_invariants(history):
    _, snapshots = history
    table = scd2_history(snapshots, "nk", TRACKED, "sk")
    count = table.count()
    assert rows(table.agg(F.min("sk"), F.max("sk"), F.countDistinct("sk"))) == [(1, count, count)]
    per_key = table.groupBy("nk").agg(F.count_if("is_current").alias("open"))
    assert per_key.filter("open != 1").count() == 0
    starts = table.select("nk", F.col("valid_from").alias("day"))
    ends = table.filter("not is_current").select("nk", F.col("valid_to").alias("day"))
    assert ends.exceptAll(starts).count() == 0


# --- types 0 and 1 -------------------------------------------------------------------------------


def test_type_1_overwrites_appends_and_leaves_the_rest(spark):
    table = scd1_merge(None, incoming(spark, (1, "a", "x"), (2, "b", "y")), "nk", TRACKED, "sk")
    table = scd1_merge(table, incoming(spark, (3, "c", "z"), (2, None, "q"), (0, "d", "w")), "nk", TRACKED, "sk")
    assert rows(table, "sk", "nk", "name", "team") == [
        (1, 1, "a", "x"), (2, 2, None, "q"), (3, 0, "d", "w"), (4, 3, "c", "z"),
    ]


def test_type_1_first_load_without_keys_is_the_input(spark):
    batch = incoming(spark, (1, "a", "x"), (2, "b", "y"))
    assert rows(scd1_merge(None, batch, "nk", TRACKED)) == rows(batch)


def test_type_1_skips_absent_tracked_columns(spark):
    table = scd1_merge(None, incoming(spark, (1, "a", "x")), "nk", TRACKED)
    table = scd1_merge(table, incoming(spark, (1, "b", "?"), (2, "c", "?")).drop("team"), "nk", TRACKED)
    assert rows(table, "nk", "name", "team") == [(1, "b", "x"), (2, "c", None)]


def test_type_1_history_equals_repeated_merges(history):
    _, snapshots = history
    table = None
    for batch in DAYS:
        slice_ = snapshots.filter(F.col("edition_seq") == batch).select("nk", *TRACKED)
        table = scd1_merge(table, slice_, "nk", TRACKED, "sk")
    whole = scd1_history(snapshots.drop("load_date"), "nk", TRACKED, "sk")
    assert rows(table, "sk", "nk", *TRACKED) == rows(whole, "sk", "nk", *TRACKED)


def test_type_0_never_updates(spark, history):
    table = scd0_merge(None, incoming(spark, (5, "a", "x")), "nk", "sk")
    table = scd0_merge(table, incoming(spark, (5, "b", "y"), (4, "c", "z")), "nk", "sk")
    assert rows(table, "sk", "nk", "name") == [(1, 5, "a"), (2, 4, "c")]
    plain, snapshots = history
    whole = scd0_history(snapshots.drop("load_date"), "nk", "sk")
    first_seen = {}
    for nk, batch, name, team in sorted(plain, key=lambda row: (row[1], row[0])):
        first_seen.setdefault(nk, (name, team))
    expected = [(sk, nk, *first_seen[nk]) for sk, nk in enumerate(first_seen, start=1)]
    assert rows(whole, "sk", "nk", *TRACKED) == sorted(expected, key=repr)


def test_changes_are_classified(spark, first):
    closed = first.withColumn("is_current", F.col("nk") != 2)
    batch = incoming(spark, (1, "Ann", "Reds"), (2, "Bob", "Reds"), (3, "Cy", None))
    assert rows(classify_changes(closed, batch, "nk", TRACKED)) == [(1, "unchanged"), (2, "closed"), (3, "new")]
    assert rows(classify_changes(first, batch, "nk", TRACKED)) == [(1, "unchanged"), (2, "changed"), (3, "new")]


# --- lookups by date -----------------------------------------------------------------------------


@pytest.mark.parametrize(("slice_days", "slice_rows"), [(5, 7), (1000, 10_000)])
def test_sliced_lookup_equals_the_join(spark, slice_days, slice_rows):
    rng, start = random.Random(3), date(2020, 1, 1)
    spans = []
    for nk in range(6):
        cuts = sorted(rng.sample(range(10, 300), 40 if nk == 0 else rng.randrange(4)) + [rng.randrange(10)])
        ends = [*(start + timedelta(days=c) for c in cuts[1:]), OPEN_END if nk % 2 == 0 else start + timedelta(days=200)]
        spans += [(nk, f"v{nk}-{c}", start + timedelta(days=c), end) for c, end in zip(cuts, ends)]
    spans.append((0, "empty", start + timedelta(days=50), start + timedelta(days=50)))
    dimension = spark.createDataFrame(spans, "nk long, label string, valid_from date, valid_to date")
    facts = [(k, 0 if k % 3 == 0 else rng.randrange(7), start + timedelta(days=rng.randrange(-5, 320))) for k in range(900)]
    facts += [(900, 0, start + timedelta(days=77))] * 60 + [(901, None, start), (902, 0, None)]
    asked = spark.createDataFrame(facts, "id long, nk long, day date")
    expected = as_of(asked.join(dimension, "nk"), F.col("day"))
    names = ["id", "nk", "day", "label", "valid_from", "valid_to"]
    found = as_of_sliced(asked, dimension, "nk", "day", slice_days, slice_rows)
    assert rows(found, *names) == rows(expected, *names)
    assert as_of_sliced(asked.limit(0), dimension, "nk", "day").isEmpty()
    assert as_of_sliced(asked, dimension.limit(0), "nk", "day").isEmpty()


def test_sliced_lookup_deals_out_a_key(spark):
    dimension = spark.createDataFrame([(1, "a", date(2020, 1, 1), OPEN_END)], "nk long, label string, valid_from date, valid_to date")
    asked = spark.range(1000).select("id", F.lit(1).cast("long").alias("nk"), F.date_add(F.lit(date(2020, 1, 1)), F.col("id").cast("int") % 50).alias("day"))
    found = as_of_sliced(asked, dimension, "nk", "day", 10, 50)
    plan = found._jdf.queryExecution().executedPlan().toString()
    window = [line for line in plan.splitlines() if "hashpartitioning(nk" in line and "_slice" in line and "_share" in line]
    assert window and found.count() == 1000
