from tillroll import catalog, session
from tillroll.sinks.buckets import write_bucketed
from tillroll.sources import standins

FOLDER = "/root/testdata/sf0.001"
SIZE = "spark.sql.files.maxPartitionBytes"


def restored(spark, *names):
    return {n: spark.conf.get(n, None) for n in names}


def put_back(spark, held):
    for name, value in held.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_tasks_do_not_grow_with_the_input(spark):
    held = restored(spark, *session.TASK_LIMITS, session.FIRST_PARTITIONS)
    try:
        for name in session.TASK_LIMITS:
            spark.conf.unset(name)
        spark.conf.set(SIZE, "1m")
        session.bound_tasks(spark, 100 * session.TASK_BYTES)
        assert spark.conf.get(SIZE) == "1m"  # lower than asked for
        assert int(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) == session.TASK_BYTES
        assert session.shuffle_partitions(spark) == 200
        session.bound_tasks(spark, 10)
        assert session.shuffle_partitions(spark) == 4
    finally:
        put_back(spark, held)


def test_buckets_follow_the_shuffles(spark, tmp_path):
    held = restored(spark, session.FIRST_PARTITIONS)
    try:
        spark.conf.set(session.FIRST_PARTITIONS, "7")
        before = {t.name for t in spark.catalog.listTables()}
        assert write_bucketed(spark.range(100), str(tmp_path / "t"), "id").count() == 100
        (name,) = {t.name for t in spark.catalog.listTables()} - before
        assert {r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "Num Buckets"} == {"7"}
    finally:
        put_back(spark, held)


def test_only_named_marts_are_stored(spark, monkeypatch):
    monkeypatch.setattr(standins, "SHARED", {})
    store = catalog.Store(session.tune(spark), FOLDER)
    made = []
    whole = catalog.Warehouse.store
    monkeypatch.setattr(catalog.Warehouse, "store", lambda self, folder, names=None, before=None: made.append(list(names)) or whole(self, folder, names, before))
    assert "dim_aisles" in store.stored(["dim_aisles", "dim_time"])
    found = store.stored(["dim_time", "user_retention"])
    assert made == [["dim_aisles", "dim_time"], ["user_retention"]]
    assert set(found) == {"dim_time", "user_retention", *(f"stg_{t}" for t in ("orders", "order_products", "products", "aisles", "departments"))}
