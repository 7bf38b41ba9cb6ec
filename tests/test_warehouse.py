"""The load of the warehouse (K5, K6, T4): a recording connection stands for the database, of which none is opened."""

import datetime as dt
import re

import pytest

from ledgerline.contracts import DIMENSIONS, FACTS, GOLD
from ledgerline.operators import audit as A
from ledgerline.operators import warehouse as W
from ledgerline.plans import medallion as M
from ledgerline.sources.layers import scan
from tests import fixtures as FX

D1, D2 = dt.date(2024, 3, 1), dt.date(2024, 3, 2)
TABLES = [*DIMENSIONS, *FACTS, "pipeline_run_audit"]


class Recorder:
    """A database of table names and row counts. ``fail``: a pattern of the statement that fails; ``copies``: rows that a repeated task left in a staging table."""

    def __init__(self, fail=None, fail_write=None, copies=0):
        self.log, self.tables, self.rows, self.fail, self.fail_write, self.copies = [], {}, {}, fail, fail_write, copies
        self.made = None

    def target(self, **more):
        return W.Target("jdbc:recorded:x", "analytics", {"user": "u"}, connect=self.connect, write=self.write, **more)

    def write(self, df, url, table, mode, properties, num_partitions, batch_size, column_types):
        self.log.append(("write", table))
        assert (url, mode, properties, num_partitions) == ("jdbc:recorded:x", "errorifexists", {"user": "u"}, 8) and table.startswith("analytics.stg_")
        name = re.sub(r"^analytics.stg_|_[0-9a-f]+$", "", table)
        assert df.schema == GOLD[name] and ("VARCHAR" in column_types) == any(t == "string" for _, t in df.dtypes)
        if self.fail_write == name:
            raise OSError("lost")
        self.tables[table] = len(df.collect()) + self.copies

    def connect(self, spark, url, properties):
        self.log.append(("connect", None))
        self.before = dict(self.rows)
        return self

    def execute(self, sql):
        self.log.append(("sql", sql))
        if self.fail and re.search(self.fail, sql):
            raise OSError(sql)
        if m := re.match(r"INSERT INTO (\S+) .* SELECT (DISTINCT )?.* FROM (\S+)$", sql):
            n = self.tables[m[3]] - (max(self.copies, 0) if m[2] else 0)
            self.rows[m[1]] = self.rows.get(m[1], 0) + n
            return n
        if m := re.match(r"DELETE FROM (\S+)", sql):
            self.rows[m[1]] = 0
        if m := re.match(r"DROP TABLE (\S+)", sql):
            del self.tables[m[1]]
        if m := re.match(r"CREATE TABLE (\S+)", sql):
            self.rows.setdefault(m[1], 0)
        return 0

    def count(self, table):
        return self.tables[table]

    def has_table(self, schema, name):
        return f"{schema}.{name}" in self.rows

    def quote(self, name):
        return f"`{name}`"

    def commit(self):
        self.log.append(("commit", None))
        self.before = dict(self.rows)

    def rollback(self):
        self.log.append(("rollback", None))
        self.rows = dict(self.before)

    def close(self):
        self.log.append(("close", None))

    def statements(self):
        return [s for kind, s in self.log if kind == "sql"]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    FX.write_drop(f"{root}/raw")
    M.run_batch(spark, f"{root}/raw", f"{root}/lake", [D1, D2])
    return root


def publish(spark, lake, recorder, days=(D1, D2)):
    return M.publish(spark, f"{lake}/lake", f"{lake}/wh", list(days), recorder.target())


def test_all_tables_change_in_one_transaction(spark, lake):
    db = Recorder()
    publish(spark, lake, db)
    kinds = [k for k, _ in db.log]
    writes = [i for i, k in enumerate(kinds) if k == "write"]
    first = kinds.index("connect")
    assert len(writes) == len(TABLES) and max(writes) < first, "every table is staged before the first connection"
    commit = kinds.index("commit")
    between = db.log[first + 1 : commit]
    assert all(k == "sql" for k, _ in between) and db.log[commit + 1][0] == "close"
    sql = [s for _, s in between]
    verbs = [s.split()[0] for s in sql]
    assert verbs[: len(TABLES)] == ["CREATE"] * len(TABLES)
    rest = [(s.split()[0], s.split()[2]) for s in sql[len(TABLES) :]]
    wanted = []
    for t in TABLES:
        wanted += ([] if t == "pipeline_run_audit" else [("DELETE", f"analytics.{t}")]) + [("INSERT", f"analytics.{t}")]
    assert rest == wanted
    assert not db.tables, "no staging table is left"
    for t in (*DIMENSIONS, *FACTS):
        assert db.rows[f"analytics.{t}"] == scan(spark, f"{lake}/lake", "gold", t).count(), t


def test_what_is_deleted(spark, lake):
    db = Recorder()
    publish(spark, lake, db, [D1])
    deletes = {s.split()[2].split(".")[1]: s for s in db.statements() if s.startswith("DELETE")}
    assert deletes["dim_customer"] == "DELETE FROM analytics.dim_customer"
    assert deletes["dim_date"].endswith("WHERE `date_key` IN (20240301)")
    assert all(deletes[f].endswith("WHERE `batch_date` IN (DATE '2024-03-01')") for f in FACTS)


def test_types_and_keys_of_the_tables(spark, lake):
    db = Recorder()
    publish(spark, lake, db, [D1])
    made = {s.split()[2].split(".")[1]: s for s in db.statements() if s.startswith("CREATE")}
    assert "`order_id` VARCHAR(32) NOT NULL" in made["fact_orders"] and "`order_total_mmk` DECIMAL(18, 2)" in made["fact_orders"]
    assert made["fact_orders"].endswith("PRIMARY KEY (`order_id`, `batch_date`))") and "`order_timestamp` TIMESTAMP" in made["fact_orders"]
    assert made["dim_region"].endswith("(`region_key` BIGINT NOT NULL, `region` VARCHAR(100), `city` VARCHAR(100), PRIMARY KEY (`region_key`))")
    assert "`is_active` BOOLEAN" in made["dim_product"] and "`customer_name` VARCHAR(255)" in made["dim_customer"]
    publish(spark, lake, db, [D1])
    assert sum(s.startswith("CREATE") for s in db.statements()) == len(TABLES), "tables are made once"


def test_a_rerun_counts_once(spark, lake):
    db = Recorder()
    for days in ([D1, D2], [D1, D2]):
        publish(spark, lake, db, days)
    assert db.rows["analytics.fact_orders"] == scan(spark, f"{lake}/lake", "gold", "fact_orders").count()
    assert db.rows["analytics.pipeline_run_audit"] == 4


@pytest.mark.parametrize("table", ["dim_customer", "fact_payments", "pipeline_run_audit"])
def test_no_statement_on_a_table_when_staging_fails(spark, lake, table):
    db = Recorder(fail_write=table)
    with pytest.raises(OSError, match="lost"):
        publish(spark, lake, db)
    assert all(s.startswith("DROP TABLE analytics.stg_") for s in db.statements()) and not db.rows and not db.tables
    failed = A.read_audit(spark, f"{lake}/lake").where("pipeline_stage = 'warehouse_load' AND status = 'FAILED'").collect()
    assert {r.batch_date for r in failed} == {D1, D2} and "lost" in failed[0].message


@pytest.mark.parametrize("fail", ["INSERT INTO analytics.fact_payments", "DELETE FROM analytics.fact_orders", "CREATE TABLE analytics.dim_date"])
def test_a_failed_change_is_rolled_back_whole(spark, lake, fail):
    db = Recorder()
    publish(spark, lake, db, [D1, D2])
    rows = dict(db.rows)
    db.fail = fail
    if fail.startswith("CREATE"):
        del db.rows["analytics.dim_date"], rows["analytics.dim_date"]
    db.log.clear()
    with pytest.raises(OSError):
        publish(spark, lake, db, [D1, D2])
    kinds = [k for k, _ in db.log]
    drops = next(i for i, (k, s) in enumerate(db.log) if k == "sql" and s.startswith("DROP"))
    assert "commit" not in kinds[:drops] and "rollback" in kinds[:drops]
    assert db.rows == rows and not db.tables


def test_copies_of_a_repeated_task_are_removed_or_refused(spark, lake):
    db = Recorder(copies=1)
    publish(spark, lake, db)
    inserts = [s for s in db.statements() if s.startswith("INSERT")]
    assert len(inserts) == len(TABLES) and all("SELECT DISTINCT" in s for s in inserts)
    assert db.rows["analytics.fact_orders"] == scan(spark, f"{lake}/lake", "gold", "fact_orders").count()
    short = Recorder(copies=-1)
    with pytest.raises(RuntimeError, match="nothing is changed"):
        publish(spark, lake, short)
    assert not any(short.rows.values())


def test_run_batch_and_run_range_load_too(spark, tmp_path):
    FX.write_drop(f"{tmp_path}/raw")
    db = Recorder()
    M.run_batch(spark, f"{tmp_path}/raw", f"{tmp_path}/lake", [D1], f"{tmp_path}/wh", jdbc=db.target())
    M.run_range(spark, f"{tmp_path}/raw", f"{tmp_path}/lake", D1, D2, f"{tmp_path}/wh", jdbc=db.target())
    assert sum(k == "commit" for k, _ in db.log) == 2 + 2 * len(TABLES)
    with pytest.raises(ValueError, match="target_root"):
        M.run_batch(spark, f"{tmp_path}/raw", f"{tmp_path}/lake", [D1], jdbc=db.target())


def test_a_target_from_a_mapping():
    assert W.target_of({"url": "jdbc:x", "schema": "s"}).name("t") == "s.t" and W.target_of({"url": "jdbc:x"}).name("t") == "t"
