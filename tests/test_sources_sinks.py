from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from quaymark import config as C
from quaymark.operators import cleaning
from quaymark.session import shared_dir, size_shuffles
from quaymark.sinks import contracts, files as out, jdbc
from quaymark.sources import files, jdbc as jdbc_source, kafka


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_malformed_rows_are_left_out_or_kept_aside(spark, rows, tmp_path):
    path = write(tmp_path / "p.csv", "product_id,product_name,category,brand,price,cost\np1,名,c,b,1.5,1\np2,n,c,b,cheap,1\n")
    assert [r["product_id"] for r in rows(files.read_typed_csv(spark, path, files.PRODUCTS))] == ["p1"]
    good, bad = files.read_csv_with_rejects(spark, path, files.PRODUCTS)
    assert [r["product_name"] for r in rows(good)] == ["名"]
    assert [r["_corrupt_record"] for r in rows(bad)] == ["p2,n,c,b,cheap,1"]
    # Whatever columns a query reads, the same rows count as fitting.
    typed = files.read_typed_csv(spark, path, files.PRODUCTS)
    assert typed.count() == good.count() == bad.count() == 1
    assert typed.select("product_id").collect() == [("p1",)]
    assert typed.agg(F.sum("cost")).first()[0] == 1.0


def test_catalogue_csv_spans_lines(spark, rows, tmp_path):
    path = write(tmp_path / "g.csv", 'AppID,Name,Release date\n1,"Half ""Game""\npart 2",2008\n')
    got = rows(files.read_catalogue_csv(spark, path))
    assert got == [{"AppID": 1, "Name": 'Half "Game"\npart 2', "Release date": 2008}]
    assert files.read_catalogue_csv(spark, path, "AppID bigint, Name string, d string").schema["d"].dataType.simpleString() == "string"


def test_listing_csv_headers_are_renamed(spark, rows, tmp_path):
    header = "市区,小区,户型,朝向,楼层,装修情况,电梯,面积(㎡),价格(万元),年份"
    path = write(tmp_path / "l.csv", f"{header}\n海淀,a,3室1厅,南,3,精装,有电梯,90,500,2001\n")
    got = rows(files.read_listings_csv(spark, path))[0]
    assert got["district"] == "海淀" and got["area"] == 90 and got["build_year"] == "2001"


def test_listing_csv_keeps_fractions_and_hands_back_misfits(spark, rows, tmp_path):
    header = "市区,小区,户型,朝向,楼层,装修情况,电梯,面积(㎡),价格(万元),年份"
    lines = ["海淀,a,3室1厅,南,3,精装,有电梯,89.5,259.5,2001", "海淀,b,3室1厅,南,x,精装,有电梯,90,500,2001"]
    path = write(tmp_path / "l.csv", "\n".join([header, *lines]) + "\n")
    good, bad = files.read_listings_with_rejects(spark, path)
    got = rows(cleaning.usable_listings(good))
    assert [(r["community"], r["area"], r["price"], r["price_per_sqm"]) for r in got] == [("a", 89.5, 259.5, 28994)]
    assert [r[0] for r in bad.collect()] == [lines[1]]
    assert files.read_listings_csv(spark, path).count() == 2


def test_other_formats(spark, rows, tmp_path):
    semi = write(tmp_path / "people.csv", "name;age;job\nJo;30;Dev\n")
    assert rows(files.read_any(spark, semi, "csv", "name string, age int, job string", sep=";", header=True))[0]["job"] == "Dev"
    lines = write(tmp_path / "people.json", '{"name":"A"}\n{"age":30,"name":"B","n":[1,2]}\n')
    got = rows(files.read_any(spark, lines, "json", "name string, age bigint, n array<int>"))
    assert got == [{"name": "A", "age": None, "n": None}, {"name": "B", "age": 30, "n": [1, 2]}]
    text = write(tmp_path / "people.txt", "Mi, 29\nAn, x\n")
    assert rows(files.read_delimited_text(spark, text, {"name": "string", "age": "int"}, ",")) == [
        {"name": "Mi", "age": 29}, {"name": "An", "age": None},
    ]
    kv = write(tmp_path / "kv.txt", "238\x01val_238\n")
    assert rows(files.read_delimited_text(spark, kv, {"k": "int", "v": "string"}, "\x01")) == [{"k": 238, "v": "val_238"}]


def test_non_empty_check_and_views(spark):
    df = spark.range(1)
    assert files.require_non_empty(df, "t") is df
    with pytest.raises(ValueError, match="users"):
        files.require_non_empty(df.filter("false"), "users")
    files.register_views({"registered": df})
    assert spark.sql("select * from registered").count() == 1


def test_jdbc_options():
    assert jdbc_source.read_options("u", "t", partition_column="id", bounds=(1, 9), partitions=4) == {
        "url": "u", "dbtable": "t", "fetchsize": "10000", "partitionColumn": "id", "lowerBound": "1",
        "upperBound": "9", "numPartitions": "4",
    }
    with pytest.raises(ValueError):
        jdbc_source.read_options("u", "t", partitions=4)
    target = jdbc.JdbcTarget("u", "me", "secret", "d")
    got = jdbc.write_options(target, "t", truncate=True)
    assert got == {"url": "u", "dbtable": "t", "batchsize": "1000", "user": "me", "password": "secret", "driver": "d", "truncate": "true"}


def test_jdbc_failures_are_raised(spark):
    with pytest.raises(Exception, match="(?i)driver|jdbc"):
        jdbc.append(spark.range(1), jdbc.JdbcTarget("jdbc:none://nowhere"), "t")


def test_jdbc_dry_run_writes_nothing(spark, capsys):
    jdbc.full_refresh(spark.range(3), jdbc.JdbcTarget("jdbc:none://nowhere"), "t", dry_run=True)
    assert "id" in capsys.readouterr().out


class FakeConnection:
    """Stands in for a database: notes what is asked of it."""

    def __init__(self):
        self.log = []

    def __getattr__(self, name):
        def call(*arguments):
            self.log.append((name, *arguments))
            return self

        return call


def test_deleting_batches_is_one_transaction():
    connection, properties = FakeConnection(), FakeConnection()
    manager = SimpleNamespace(getConnection=lambda url, props: connection)
    util = SimpleNamespace(Properties=lambda: properties)
    spark = SimpleNamespace(_jvm=SimpleNamespace(java=SimpleNamespace(sql=SimpleNamespace(DriverManager=manager), util=util)))
    jdbc.delete_values(spark, jdbc.JdbcTarget("jdbc:x", user="u"), "t", "checkid", [3, 5])
    assert ("setProperty", "user", "u") in properties.log
    assert connection.log == [
        ("setAutoCommit", False),
        ("prepareStatement", "DELETE FROM t WHERE checkid = ?"),
        ("setObject", 1, 3),
        ("executeUpdate",),
        ("setObject", 1, 5),
        ("executeUpdate",),
        ("commit",),
        ("close",),
    ]


def test_statements_run_in_one_transaction_or_not_at_all():
    connection = FakeConnection()
    manager = SimpleNamespace(getConnection=lambda url, props: connection)
    util = SimpleNamespace(Properties=lambda: FakeConnection())
    spark = SimpleNamespace(_jvm=SimpleNamespace(java=SimpleNamespace(sql=SimpleNamespace(DriverManager=manager), util=util)))
    statements = jdbc.replacement("t", "t_staging", "checkid", ["checkid", "v"])
    jdbc.run_in_transaction(spark, jdbc.JdbcTarget("jdbc:x"), statements)
    assert [c[0] for c in connection.log] == ["setAutoCommit", *["prepareStatement", "executeUpdate", "close"] * 2, "commit", "close"]
    assert connection.log[4] == ("prepareStatement", "INSERT INTO t (checkid, v) SELECT checkid, v FROM t_staging")
    connection.log.clear()

    def fails(*_):
        raise OSError("lost")

    connection.executeUpdate = fails
    with pytest.raises(OSError):
        jdbc.run_in_transaction(spark, jdbc.JdbcTarget("jdbc:x"), statements)
    assert [c[0] for c in connection.log][-2:] == ["rollback", "close"] and ("commit",) not in connection.log


def test_replacing_batches_in_a_database_deletes_and_appends(spark, monkeypatch):
    done = []
    monkeypatch.setattr(jdbc, "delete_values", lambda _, target, table, column, values: done.append(("delete", table, column, sorted(values))))
    monkeypatch.setattr(jdbc, "append", lambda rows, target, table, writers: done.append(("append", table, rows.count(), writers)))
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "checkid int, v string")
    jdbc.replace_batches(rows, jdbc.JdbcTarget("jdbc:x"), "t", writers=3)
    assert done == [("delete", "t", "checkid", [1, 2]), ("append", "t", 3, 3)]


def test_replace_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    out.replace_batches(spark.createDataFrame([(1, "a"), (2, "b")], "checkid int, v string"), path)
    out.replace_batches(spark.createDataFrame([(2, "c")], "checkid int, v string"), path)
    assert sorted((r["checkid"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "c")]


def test_save_csv_is_one_headed_file(spark, tmp_path):
    path = tmp_path / "c"
    out.save_csv(spark.range(10).withColumn("t", F.lit('q"x')), str(path))
    out.save_csv(spark.range(10).withColumn("t", F.lit('q"x')), str(path))
    assert len(list(path.glob("part-*"))) == 1
    back = spark.read.option("header", True).option("escape", '"').csv(str(path))
    assert back.count() == 10 and back.first()["t"] == 'q"x'


def test_topic_options():
    got = kafka.source_options(["a:1", "b:2"], "t", max_offsets=500, fail_on_data_loss=False)
    assert got == {"kafka.bootstrap.servers": "a:1,b:2", "subscribe": "t", "startingOffsets": "latest",
                   "failOnDataLoss": "false", "maxOffsetsPerTrigger": "500"}
    assert kafka.source_options("a:1", "t", "earliest")["startingOffsets"] == "earliest"
    assert out.topic_options("a:1", "t")["kafka.acks"] == "all"


def test_contract(spark):
    contract = contracts.Contract({"k": "int", "v": "decimal(18,2)"}, ("k",), nullable=("v",))
    good = spark.createDataFrame([(1, 1.239), (2, None)], "k bigint, v double")
    fitted = contracts.checked(good, contract)
    assert fitted.dtypes == [("k", "int"), ("v", "decimal(18,2)")]
    with pytest.raises(ValueError, match="duplicate key"):
        contracts.checked(good.union(good), contract)
    with pytest.raises(ValueError, match="null in a required"):
        contracts.checked(spark.createDataFrame([(None, 1.0)], "k int, v double"), contract)


def test_contract_counts_while_writing(spark):
    contract = contracts.Contract({"k": "int", "v": "decimal(4,2)", "w": "int"}, ("k",), nullable=("v",))
    counts = {}
    good = spark.createDataFrame([(n, None if n % 2 else 1.5, "7") for n in range(50)], "k bigint, v double, w string").repartition(5)
    assert contracts.checked(good, contract, counts).count() == counts["rows"] == 50
    assert {n for name, n in counts.items() if name != "rows"} == {0}
    assert contracts.checked(good.limit(0), contract, counts).count() == counts["rows"] == 0
    for row, name in (((1 << 40, 1.0, "7"), "misfits k"), ((1, 123.0, "7"), "misfits v"), ((1, 1.0, "x"), "misfits w")):
        with pytest.raises(ValueError, match=f"do not fit.*{name}"):
            contracts.checked(good.union(spark.createDataFrame([row], good.schema)), contract, counts)
        assert counts["rows"] == 51 and counts[name] == 1


def test_config():
    got = C.parse(["commerce", "--input", "x", "--top-n", "3", "--min-support", "0.1", "--dry-run"])
    assert (got.job, got.input, got.top_n, got.min_support, got.dry_run) == ("commerce", "x", 3, 0.1, True)
    assert got.min_confidence == 0.10 and got.window_duration == "1 minute"
    for bad in (["--top-n", "0"], ["--min-support", "1.5"], ["--trigger-seconds", "-1"], ["--shuffle-partitions", "0"]):
        with pytest.raises(ValueError):
            C.parse(["commerce", *bad])
    with pytest.raises(SystemExit):
        C.parse(["commerce", "--unknown"])


def _session(master, setting=None):
    context = SimpleNamespace(master=master, applicationId="app-1")
    conf = SimpleNamespace(get=lambda key, default=None: setting if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_shared_dir_follows_the_session_setting():
    assert shared_dir(_session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_dir(_session("local[2]", "/shared")) == "/shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_session("yarn"))
    fallback = shared_dir(_session("local[2]"))
    assert fallback == shared_dir(_session("local[2]"))


def test_shuffles_are_sized_by_the_input(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"x" * 10_000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, str(tmp_path), target_bytes=1000) == 10
        assert size_shuffles(spark, f"{tmp_path}/*", target_bytes=100) == 100
        assert size_shuffles(spark, str(tmp_path / "missing")) == 100
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
