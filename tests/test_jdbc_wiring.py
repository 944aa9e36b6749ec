"""JDBC wiring without a database: a fake session records what the reader/writer are asked."""

from reviewflow.sinks import tables as TB
from reviewflow.sources import jdbc as J


class FakeDF:
    def __init__(self, log, rows=None):
        self.log, self.rows = log, rows or []

    def select(self, *cols):
        self.log.append(("select", cols))
        return self

    def first(self):
        return self.rows[0] if self.rows else None

    def take(self, n):
        return self.rows[:n]


class FakeReader:
    def __init__(self, log, rows):
        self.log, self.rows = log, rows

    def format(self, f):
        self.log.append(("format", f))
        return self

    def options(self, **o):
        self.log.append(("options", o))
        return self

    def load(self):
        return FakeDF(self.log, self.rows)


class FakeSpark:
    def __init__(self, rows=None):
        self.log = []
        self.read = FakeReader(self.log, rows)


def test_read_table_projects_and_partitions():
    s = FakeSpark()
    J.read_table(s, "reviews", ["a", "b"], "jdbc:x://h/db", user="u", password="p", partition_column="id",
                 lower_bound=1, upper_bound=100, num_partitions=4, fetch_size=500)
    opts = dict(s.log)["options"]
    assert opts["dbtable"] == "reviews" and opts["partitionColumn"] == "id" and opts["numPartitions"] == "4"
    assert (opts["lowerBound"], opts["upperBound"], opts["fetchsize"]) == ("1", "100", "500")
    assert ("select", ("a", "b")) in s.log


def test_partitioned_read_asks_the_database_for_bounds():
    s = FakeSpark(rows=[{"lo": 3, "hi": 90}])
    J.read_table_partitioned(s, "reviews", "id", ["a"], "jdbc:x://h/db", num_partitions=8)
    queries = [o["query"] for k, o in s.log if k == "options" and "query" in o]
    assert queries == ["SELECT MIN(id) AS lo, MAX(id) AS hi FROM reviews"]
    last = [o for k, o in s.log if k == "options"][-1]
    assert (last["lowerBound"], last["upperBound"], last["numPartitions"]) == ("3", "90", "8")


def test_table_exists_uses_exact_name():
    s = FakeSpark(rows=[("hospital_lists_ingestion",)])
    assert J.jdbc_table_exists(s, "hospital_lists_ingestion", "jdbc:x://h/db")
    q = [o["query"] for k, o in s.log if k == "options"][0]
    assert "table_name = 'hospital_lists_ingestion'" in q and "LIKE" not in q
    assert not J.jdbc_table_exists(FakeSpark(rows=[]), "missing", "jdbc:x://h/db")


def test_append_table_sets_batchsize_and_append_mode(monkeypatch):
    calls = {}

    class W:
        def format(self, f):
            calls["format"] = f
            return self

        def options(self, **o):
            calls["options"] = o
            return self

        def mode(self, m):
            calls["mode"] = m
            return self

        def save(self):
            calls["saved"] = True

    class Obs:
        get = {"rows": 7}

    class DF:
        write = W()

    monkeypatch.setattr(TB, "observed", lambda df, name="rows": (DF(), Obs()))
    assert TB.append_table(object(), "t", "jdbc:x://h/db", user="u", num_partitions=4) == 7
    assert calls["mode"] == "append" and calls["options"]["batchsize"] == "1000"
    assert calls["options"]["numPartitions"] == "4" and "mode" not in calls["options"] and calls["saved"]
