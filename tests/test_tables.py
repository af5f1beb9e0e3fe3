"""Where declared sources come from."""

import pytest

from tributary.sources.tables import from_frames, from_jdbc, from_parquet


class Reader:
    """Stands in for Spark's reader: keeps the options of every load."""

    def __init__(self, loads, bounds):
        self.loads, self.bounds, self.chosen = loads, bounds, {}

    def format(self, name):
        assert name == "jdbc"
        return self

    def option(self, key, value):
        return self.options(**{key: value})

    def options(self, **chosen):
        self.chosen |= chosen
        return self

    def load(self):
        self.loads.append(self.chosen)
        return self

    def first(self):
        return self.bounds


class Session:
    def __init__(self, bounds=None):
        self.loads, self.bounds = [], bounds

    @property
    def read(self):
        return Reader(self.loads, self.bounds)


def test_database_tables_are_read_in_ranges_between_their_own_bounds():
    session = Session(bounds=(3, 900))
    load = from_jdbc(session, "jdbc:x:shop", {"orders": "order_id"}, partitions=8, user="u")
    load("orders")
    question, read = session.loads
    assert question["query"] == "SELECT MIN(order_id) AS low, MAX(order_id) AS high FROM orders"
    assert read == {
        "url": "jdbc:x:shop", "user": "u", "dbtable": "orders", "partitionColumn": "order_id",
        "lowerBound": "3", "upperBound": "900", "numPartitions": 8,
    }


@pytest.mark.parametrize("keys, loads", [({}, 1), ({"orders": "order_id"}, 2)])
def test_database_tables_without_keys_are_read_as_they_are(keys, loads):
    session = Session(bounds=(None, None))
    from_jdbc(session, "jdbc:x:shop", keys)("orders")
    assert len(session.loads) == loads
    assert session.loads[-1] == {"url": "jdbc:x:shop", "dbtable": "orders"}


def test_undeclared_tables_are_refused(spark, tmp_path):
    for load in (from_jdbc(Session(), "jdbc:x:shop", {}), from_frames({}), from_parquet(spark, str(tmp_path))):
        with pytest.raises(KeyError, match="not a declared source table"):
            load("orders; drop table orders")
