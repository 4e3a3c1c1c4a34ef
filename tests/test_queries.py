"""Each registered query with SQL gives DuckDB's rows at the smallest size."""

import duckdb
import pytest

import __spark_entry__ as entry
from ambula.plans import catalogue

DIR = "/root/testdata/sf0.001"
SLOW: set[str] = set()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(None if v != v or v is None else int(v) if isinstance(v, float) and v == int(v) else v for v in r) for r in frame.astype(object).where(frame.notna(), None).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(set(catalogue.ORACLE_SQL) - SLOW))
def test_query(spark, duck, name):
    mine, theirs = catalogue.QUERIES[name](spark, DIR).toPandas(), duck.execute(catalogue.ORACLE_SQL[name]).fetchdf()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)


def test_bilinear_elev_rounds_as_its_sql(spark):
    """At sf0.1 some heights are a half of a centimetre in single precision, and a little less in double."""
    d = "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute(f"create view customer as select * from '{d}/customer.parquet'")
    assert rows(catalogue.QUERIES["bilinear_elev"](spark, d).toPandas()) == rows(con.execute(catalogue.ORACLE_SQL["bilinear_elev"]).fetchdf())


def test_every_point_in_ring(spark):
    from ambula.plans import fixtures as fx

    b, n = fx.geo_buildings(spark, DIR).toPandas(), fx.geo_nodes(spark, DIR).toPandas()
    lng, lat = n.lng.to_numpy(), n.lat.to_numpy()
    want = {(r.building_id, k) for r in b.itertuples() for k in n.node_id[(lng >= r.clng - r.half) & (lng < r.clng + r.half) & (lat >= r.clat - r.half) & (lat < r.clat + r.half)]}
    found = [tuple(r) for r in catalogue.QUERIES["point_in_ring"](spark, DIR).collect()]
    assert len(found) == len(set(found)) and set(found) == want


def test_grid_over_all_nodes(spark):
    """At sf0.1 most nodes lie north of the box of the SQL; directions and patches reach the last rows of all nodes."""
    d = "/root/testdata/sf0.1"
    grid = catalogue._grid(spark, d)
    west, south, east, north = grid.bbox()
    box = catalogue.raster.extent(catalogue.fx.geo_nodes(spark, d))
    assert west <= box[0] and south <= box[1] and east >= box[2] and north >= box[3]
    for name in ("dir_paint", "absorbed_cells"):
        y = [r.y for r in catalogue.QUERIES[name](spark, d).select("y").distinct().collect()]
        assert min(y) < 5 and max(y) > grid.h - 5 and len(y) > 0.9 * grid.h


def test_archive_directories(spark):
    """Every node is in the directory of its row, as written by tiles.archive_directory; decoded by hand."""
    import gzip

    nodes = catalogue.fx.geo_nodes(spark, DIR).toPandas().sort_values("node_id")
    found = catalogue.QUERIES["archive_directories"](spark, DIR).collect()
    assert sorted(r.gy for r in found) == sorted(set(nodes.gy)) and sum(r.n_tiles for r in found) == len(nodes)
    for r in found:
        numbers, shift = [0], 0
        for b in gzip.decompress(r.directory):
            numbers[-1] |= (b & 127) << shift
            shift += 7
            if b < 128:
                numbers.append(0)
                shift = 0
        own, n = nodes[nodes.gy == r.gy], r.n_tiles
        ids, lengths = own.node_id.tolist(), (own.gx + 1).tolist()
        steps = [b - a for a, b in zip([0, *ids], ids)]
        assert numbers[:-1] == [n, *steps, *[1] * n, *lengths, 1, *[0] * (n - 1)]


def test_methods_agree(spark):
    a = {tuple(r) for r in catalogue.QUERIES["sssp_by_rounds"](spark, DIR).collect()}
    b = {tuple(r) for r in catalogue._labels(spark, DIR).collect()}
    assert a == b


def test_entry(spark):
    assert set(entry.queries()) >= set(catalogue.QUERIES) and entry.entry(spark).columns
