"""JDBC sinks and source: the options handed to Spark's writer and reader.

No database is started here (one visible only to this process would prove
nothing about a cluster); the writer is replaced by a recorder.
"""

import pytest

from landfall.sinks import jdbc as J
from landfall.sources.jdbc import read_jdbc


class Recorder:
    def __init__(self):
        self.calls = []

    def format(self, f):
        self.calls.append(("format", f))
        return self

    def options(self, **kw):
        self.calls.append(("options", kw))
        return self

    def mode(self, m):
        self.calls.append(("mode", m))
        return self

    def save(self):
        self.calls.append(("save",))

    def load(self):
        self.calls.append(("load",))
        return "df"

    def opts(self):
        return next(c[1] for c in self.calls if c[0] == "options")


class FakeFrame:
    def __init__(self):
        self.write = Recorder()


def test_replace_truncates_and_keeps_definition():
    df = FakeFrame()
    J.replace_jdbc(df, "jdbc:x://h/db", "dbo.t", user="u", password="p", num_partitions=16)
    o = df.write.opts()
    assert o["truncate"] == "true" and o["dbtable"] == "dbo.t" and o["numPartitions"] == "16"
    assert ("mode", "overwrite") in df.write.calls and ("save",) in df.write.calls


def test_recreate_and_append():
    df = FakeFrame()
    J.recreate_jdbc(df, "jdbc:x://h/db", "t")
    assert df.write.opts()["truncate"] == "false" and ("mode", "overwrite") in df.write.calls
    df = FakeFrame()
    J.append_jdbc(df, "jdbc:x://h/db", "t", batch_size=500)
    assert df.write.opts()["batchsize"] == "500" and ("mode", "append") in df.write.calls


def test_partitioned_read_options():
    class S:
        read = Recorder()

    s = S()
    assert read_jdbc(s, "jdbc:x://h/db", "t", partition_column="id", lower_bound=0, upper_bound=100,
                     num_partitions=8) == "df"
    o = s.read.opts()
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == ("id", "0", "100", "8")
    with pytest.raises(ValueError):
        read_jdbc(s, "jdbc:x://h/db", "t", partition_column="id")


def test_run_load_copies_validated_snapshot_and_reconciles(spark, tmp_path, monkeypatch):
    import landfall.plans.run as R
    from landfall.plans import feeds
    from tests.conftest import write_text

    p = write_text(str(tmp_path / "v.txt"), "Patient MRN|Admit Date or Service Date\n1|1/5/2024\n2|1/6/2024\n")
    copied = {}

    def fake_replace(df, **kw):
        copied["rows"] = df.count()
        copied["kw"] = kw

    monkeypatch.setattr(R, "replace_jdbc", fake_replace)
    monkeypatch.setattr(R, "read_jdbc", lambda spark, **kw: spark.range(copied["rows"]))
    conn = dict(url="jdbc:x://h/db", table="dbo.visits", user="u", password="p", num_partitions=4)
    o = R.run_load(spark, feeds.VISITS, p, lake_root=str(tmp_path / "lake"), audit_root=str(tmp_path / "a"),
                   jdbc=conn)
    assert o.status == "SUCCEEDED" and copied["rows"] == 2 and copied["kw"]["table"] == "dbo.visits"

    monkeypatch.setattr(R, "read_jdbc", lambda spark, **kw: spark.range(1))  # the table lost a row
    o = R.run_load(spark, feeds.VISITS, p, lake_root=str(tmp_path / "lake"), audit_root=str(tmp_path / "a"),
                   jdbc=conn)
    assert o.status == "FAILED" and o.error_type == "CountMismatch"
