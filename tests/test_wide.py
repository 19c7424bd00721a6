import random

import pytest
from pyspark.sql import functions as F

from quayline.operators.joins import Lookup, WideJob, dictionary_slice, widen
from quayline.plans import wide
from quayline.functions.columns import day_of_time
from quayline.checks.derived import DerivedTables

JOB = WideJob(
    name="shipments", role="ship", table="ships",
    lookups=(
        Lookup("owner", "owners", "id", "ship.owner"),
        Lookup("home", "addresses", "owner", "owner.id"),
        Lookup("start", "places", "id", "ship.start"),
        Lookup("goal", "places", "id", "ship.goal"),
        Lookup("kind", "codes", "code", "ship.kind", 18),
    ),
    columns=("ship.id", "owner.name AS owner", "home.street AS street", "kind.codeDesc AS kind",
             "concat(start.name, goal.name) AS route"),
    day=day_of_time, day_column="ship.cdt")


@pytest.fixture(scope="module")
def tables(spark):
    frames = {
        "ships": spark.createDataFrame(
            [(1, 1, 1, 2, 1, "2020-01-02 00:00:00"), (2, 9, 2, 1, 2, "2020-01-03 10:00:00"),
             (3, None, 1, 3, 3, None), (4, 2, None, 2, 1, "no time")],
            "id long, owner long, start long, goal long, kind int, cdt string"),
        "owners": spark.createDataFrame([(1, "Ann"), (2, "Bob"), (3, "Cy")], "id long, name string"),
        "addresses": spark.createDataFrame([(12, 1, "B"), (11, 1, "A"), (13, 3, "C"), (14, None, "D")],
                                           "id long, owner long, street string"),
        "places": spark.createDataFrame([(1, "X"), (2, "Y"), (3, None)], "id long, name string"),
        "codes": spark.createDataFrame(
            [(1, 18, "1", "truck"), (2, 18, "two", "cart"), (3, 17, "3", "no"), (4, 18, "1", "later twin")],
            "id long, type int, code string, codeDesc string"),
    }
    return frames.__getitem__


EXPECTED = [(1, "Ann", "A", "truck", "XY", "20200102"), (2, None, None, None, "YX", "20200103"),
            (3, None, None, None, None, None), (4, "Bob", None, "truck", None, None)]


@pytest.mark.parametrize("threshold", ["64m", "-1"])
@pytest.mark.parametrize("nested", [True, False])
def test_every_shape_gives_the_same_rows(spark, tables, rows, nested, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        assert rows(widen(JOB, tables, nested=nested)) == EXPECTED
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64m")


@pytest.mark.parametrize("seed, threshold", [(1, "64m"), (2, "-1"), (3, "-1")])
def test_against_all_copies(spark, rows, seed, threshold):
    """Random tables, a third of the keys hot or NULL: make every copy, keep the one with the smallest ids."""
    rng = random.Random(seed)

    def key(n):
        return rng.choice([7, None, rng.randint(1, n)])

    ships = [(i, key(20), key(9), key(9), rng.choice([1, 2, 3, None])) for i in range(1, 120)]
    owners = [(i, f"owner {i}") for i in range(1, 15)]
    addresses = [(100 + i, key(20), f"street {i}") for i in range(60)]
    places = [(i, rng.choice([None, f"place {i}"])) for i in range(1, 9)]
    codes = [(i, rng.choice([17, 18]), rng.choice(["1", "2", "x", "03"]), f"text {i}") for i in range(12)]
    expected = []
    for ship, owner, start, goal, kind in ships:
        owned = [o for o in owners if o[0] == owner] or [(None, None)]
        homes = [a for a in addresses if owned[0][0] is not None and a[1] == owned[0][0]] or [(0, None, None)]
        kinds = [c for c in codes if c[1] == 18 and c[2].isdigit() and int(c[2]) == kind] or [(0, 0, None, None)]
        names = [next((p[1] for p in places if p[0] == place), None) for place in (start, goal)]
        best = min((home[0], code[0], home[2], code[3]) for home in homes for code in kinds)
        expected.append((ship, owned[0][1], best[2], best[3], None if None in names else "".join(names), "20200102"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        frames = {
            "ships": spark.createDataFrame([(*s, "2020-01-02 00:00:00") for s in ships],
                                           "id long, owner long, start long, goal long, kind int, cdt string"),
            "owners": spark.createDataFrame(owners, "id long, name string"),
            "addresses": spark.createDataFrame(addresses, "id long, owner long, street string"),
            "places": spark.createDataFrame(places, "id long, name string"),
            "codes": spark.createDataFrame(codes, "id long, type int, code string, codeDesc string"),
        }
        assert rows(widen(JOB, frames.__getitem__)) == sorted(expected, key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64m")


def test_unused_lookups_are_not_joined(tables):
    plan = widen(JOB, tables, columns=["id", "kind"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_dictionary_slice(tables, rows):
    assert rows(dictionary_slice(tables("codes"), 17, "c", "t")) == [("3", "no")]


@pytest.mark.parametrize("job, edges, columns", [
    (wide.EXPRESS_BILL, 10, 23), (wide.WAYBILL, 15, 47), (wide.TRANSPORT_RECORD, 12, 39),
    (wide.BRANCH_VEHICLE, 6, 31)])
def test_jobs_are_complete(job, edges, columns):
    assert (len(job.lookups), len(job.output())) == (edges, columns)


@pytest.mark.parametrize("job", wide.JOBS.values(), ids=lambda j: j.name)
def test_a_slice_of_the_fact_gives_its_part_of_the_table(spark, folder, rows, job):
    tables = DerivedTables(spark, folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = wide.wide_table(job, tables)
        flat = wide.wide_table(job, tables, nested=False)
        assert rows(whole) == rows(flat)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64m")
    if job.key is None:
        day = whole.agg(F.max("day")).first()[0]
        slice_ = tables(job.table).where(F.replace(F.substring("cdt", 1, 10), F.lit("-"), F.lit("")) == day)
        assert rows(wide.wide_table(job, tables, slice_, nested=False)) == rows(whole.where(F.col("day") == day))


def test_ordered_by_creation(spark, folder):
    found = [r["cdt"] for r in wide.wide_table(wide.EXPRESS_BILL, DerivedTables(spark, folder), ordered=True,
                                               columns=["id", "cdt"]).collect()]
    assert found == sorted(found)


@pytest.fixture
def small_skew(spark):
    """Adaptive execution that takes notice of small skewed partitions, and no broadcasts."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["id", "owner"])
def test_a_hot_key_is_split(spark, small_skew, key):
    """A third of the fact on one key, of a unique dimension and of one that is reduced first: no row is lost."""
    ships = spark.range(0, 300_000, 1, 8).selectExpr(
        "id", "if(id % 3 = 0, 7, id) AS owner", "sha2(string(id), 256) AS cdt")
    owners = spark.range(300_000).selectExpr("id", "id AS owner", "concat('owner ', id) AS name")
    job = WideJob("s", "ship", "ships", (Lookup("owner", "owners", key, "ship.owner"),),
                  ("ship.id", "ship.cdt", "owner.name AS owner"))
    found = widen(job, {"ships": ships, "owners": owners}.__getitem__)
    assert found.count() == 300_000 and found.where("owner = 'owner 7'").count() == 100_001
    assert "skew=true" in _final_plan(found)


def test_null_keys_are_spread(spark, small_skew):
    ships = spark.range(0, 300_000, 1, 8).selectExpr(
        "id", "if(id % 3 = 0, NULL, id) AS owner", "sha2(string(id), 256) AS cdt")
    owners = spark.range(300_000).selectExpr("id", "concat('owner ', id) AS name")
    job = WideJob("s", "ship", "ships", (Lookup("owner", "owners", "id", "ship.owner"),),
                  ("ship.id", "ship.cdt", "owner.name AS owner"))
    found = widen(job, {"ships": ships, "owners": owners}.__getitem__)
    assert found.count() == 300_000 and found.where("owner IS NULL").count() == 100_000
    assert "skew=true" not in _final_plan(found)


def test_the_sorted_wide_table_keeps_every_row_and_column(spark, folder):
    from quayline.checks.queries import QUERIES
    found, whole = QUERIES["sorted_wide"](spark, folder), QUERIES["wide_express_bill"](spark, folder)
    assert found.columns == [*whole.columns, "rows", "first_place", "last_place", "n"]
    assert found.count() == whole.count() == spark.read.parquet(f"{folder}/orders.parquet").count()
    assert found.where("first_place <> last_place").count() == 0
