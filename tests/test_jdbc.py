"""The options handed to Spark's JDBC source; no database is involved."""

from tenderline.sources.stores import HashSlices, JdbcStore, RangeSlices

SECRET = {"user": "u", "password": "hidden", "driver": "org.postgresql.Driver"}


def store(**more):
    return JdbcStore("jdbc:postgresql://host:5432/db?ssl=true", SECRET, **more)


def test_tables_get_the_default_schema():
    assert store().read_options("requests")["dbtable"] == "public.requests"
    assert store().read_options("other.requests")["dbtable"] == "other.requests"


def test_properties_stay_out_of_text():
    assert "hidden" not in repr(store())
    assert store().read_options("t")["password"] == "hidden"


def test_range_slices():
    cut = store(slices={"orders": RangeSlices("id", 1, 900, 64)})
    options = cut.read_options("orders")
    assert options["partitionColumn"] == "id"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "900")
    assert options["numPartitions"] == "64"
    assert "partitionColumn" not in cut.read_options("others")


def test_hash_slices_cover_every_row_once():
    conditions = HashSlices("id", 3).predicates()
    assert len(conditions) == 3
    for value in (0, 1, 2, 3, -4, None):
        hits = 0
        for k, text in enumerate(conditions):
            assert f"MOD(ABS(id), 3) = {k}" in text
            hits += ("IS NULL" in text) if value is None else abs(value) % 3 == k
        assert hits == 1


def test_queries_run_in_the_database():
    options = store().query_options("SELECT id FROM sales WHERE amount > 100;\n")
    assert options["query"] == "SELECT id FROM sales WHERE amount > 100"
    assert "dbtable" not in options


def test_write_options():
    plain = store(writers=16).write_options("t")
    assert plain["numPartitions"] == "16" and "truncate" not in plain
    kept = store().write_options("t", keep_table=True, types="name VARCHAR(255)", page=1000)
    assert kept["truncate"] == "true"
    assert kept["createTableColumnTypes"] == "name VARCHAR(255)"
    assert kept["batchsize"] == "1000"


def test_same_table_is_recognised():
    assert store().identity("t") == JdbcStore("jdbc:postgresql://HOST:5432/db").identity("public.T")
    assert store().identity("t") != JdbcStore("jdbc:postgresql://host:5432/other").identity("t")


def test_slices_by_any_name_and_sliced_query():
    cut = RangeSlices("id", 1, 9, 4)
    store = JdbcStore("jdbc:x", slices={"t": cut})
    assert store.cut("public.t") is cut and store.cut("PUBLIC.T") is cut and store.cut("other.t") is None
    options = store.query_options("SELECT id FROM t;", cut)
    assert options["dbtable"] == "(SELECT id FROM t) q" and options["numPartitions"] == "4" and "query" not in options
