import json
import random

import pytest

from tributary.sources.pages import KeyRange, KeysOutOfOrder, keyset_source, walk_keys


class Service:
    """Rows by key, some of which come and go with every page that is fetched."""

    def __init__(self, keys, seed):
        self.rows = {k: {"id": k, "x": f"v{k}"} for k in keys}
        self.random = random.Random(seed)
        self.stays = set(keys)

    def fetch(self, low, high, limit):
        found = sorted(k for k in self.rows if (low is None or k > low) and (high is None or k <= high))
        page = [self.rows[k] for k in found[:limit]]
        for _ in range(3):
            gone = self.random.choice(sorted(self.rows))
            self.rows.pop(gone)
            self.stays.discard(gone)
            new = self.random.randrange(10_000)
            if new not in self.stays:
                self.rows[new] = {"id": new, "x": "new"}
        return page


@pytest.mark.parametrize("seed", range(10))
def test_rows_that_stay_occur_once(seed):
    service = Service(range(0, 5000, 5), seed)
    ends = [1000, 2000, 2500, 4000]
    seen = []
    for low, high in zip([None, *ends], [*ends, None], strict=True):
        for page in walk_keys(service.fetch, "id", KeyRange(low, high), 37):
            seen += [r["id"] for r in page]
    assert len(seen) == len(set(seen))
    assert service.stays <= set(seen)


def test_a_service_without_an_order_is_noticed():
    pages = [[{"id": 1}, {"id": 3}], [{"id": 2}]]
    with pytest.raises(KeysOutOfOrder):
        list(walk_keys(lambda *_: pages.pop(0), "id", KeyRange(None, None), 2))
    with pytest.raises(KeysOutOfOrder):
        list(walk_keys(lambda *_: [{"id": 9}], "id", KeyRange(None, 5), 2))


def test_as_a_data_source(spark, tmp_path):
    """The service is a file of rows; ranges of a key of which one value is frequent in the quantiles."""
    path = str(tmp_path / "rows.json")
    with open(path, "w") as file:
        json.dump([{"id": k, "x": None if k % 3 else f"v{k}", "n": k / 2} for k in range(0, 700, 7)], file)

    def load():
        with open(path) as file:
            return json.load(file)

    def fetch(low, high, limit):
        own = [r for r in load() if (low is None or r["id"] > low) and (high is None or r["id"] <= high)]
        return sorted(own, key=lambda r: r["id"])[:limit]

    def quantiles(parts):
        keys = [r["id"] for r in load()]
        return [keys[len(keys) * n // parts] for n in range(1, parts)] + [keys[0], keys[0]]

    spark.dataSource.register(keyset_source(fetch, quantiles, "id"))
    df = spark.read.format("keyset_json").options(columns="id,x,n", pageSize="9", tasks="4").load()
    assert df.rdd.getNumPartitions() == 5
    got = sorted((int(r.id), r.x, r.n) for r in df.collect())
    assert got == [(k, None if k % 3 else f"v{k}", str(k / 2)) for k in range(0, 700, 7)]
