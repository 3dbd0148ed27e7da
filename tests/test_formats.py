"""Sources read through the format/options path give the same features."""

import uuid

from featuremart.operators.parallelism import spread_for_cpu
from featuremart.plans.batch_features import build_batch_features
from featuremart.session import shared_dir
from featuremart.sources.tables import load_sources
from tests.fixtures import RUN, micro_sources


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_sources_match_in_memory(spark):
    base = f"{shared_dir(spark)}/featuremart-test/csv-{uuid.uuid4().hex}"
    src = micro_sources(spark)
    paths = {}
    for name in ("customers", "sessions", "events", "orders"):
        paths[name] = f"{base}/{name}"
        getattr(src, name).write.option("header", True).csv(paths[name])
    options = {"header": "true", "inferSchema": "true", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}
    from_csv = load_sources(spark, RUN, paths, fmt="csv", options=options)
    assert _rows(build_batch_features(from_csv)) == _rows(build_batch_features(src))


def test_spread_only_on_demand(spark):
    df = spark.range(0, 1000, numPartitions=1)
    assert spread_for_cpu(df, None) is df
    assert "hashpartitioning(id" in spread_for_cpu(df, 4, key="id")._jdf.queryExecution().executedPlan().toString()


class _Reader:
    """Stands for spark.read and records what each load is given."""

    def __init__(self):
        self.seen = []

    @property
    def read(self):
        return self

    def format(self, fmt):
        self.now = {"format": fmt}
        return self

    def options(self, **options):
        self.now |= options
        return self

    def load(self, *path):
        self.seen.append(self.now)
        return self.now


def test_each_table_has_its_own_options():
    from featuremart.cli import _options

    given = ["url=jdbc:x", "fetchsize=100", "events.dbtable=raw.events", "events.partitionColumn=event_id",
             "events.fetchsize=5", "orders.dbtable=raw.orders", "customers.dbtable=c", "sessions.dbtable=s", "oracle.net=1"]
    reader = _Reader()
    load_sources(reader, RUN, None, "jdbc", _options(given))
    common = {"format": "jdbc", "url": "jdbc:x", "oracle.net": "1"}
    assert reader.seen == [
        common | {"fetchsize": "100", "dbtable": "c"},
        common | {"fetchsize": "100", "dbtable": "s"},
        common | {"fetchsize": "5", "dbtable": "raw.events", "partitionColumn": "event_id"},
        common | {"fetchsize": "100", "dbtable": "raw.orders"},
    ]


def test_batched_write_options():
    from featuremart.models.sales_model import write_results

    class Writer:
        def __init__(self):
            self.seen = {}

        write = property(lambda self: self)

        def mode(self, m):
            self.seen["mode"] = m
            return self

        def format(self, f):
            self.seen["format"] = f
            return self

        def options(self, **o):
            self.seen |= o
            return self

        def option(self, k, v):
            self.seen[k] = v
            return self

        def save(self, *path):
            self.seen["path"] = path

    w = Writer()
    write_results(w, "unused", "jdbc", {"url": "jdbc:x", "dbtable": "forecasts"}, batch_size=500)
    assert w.seen == {"mode": "overwrite", "format": "jdbc", "url": "jdbc:x", "dbtable": "forecasts", "batchsize": 500, "path": ()}
