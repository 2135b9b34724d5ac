"""Rows that once went missing: null keys, deep nesting, long numbers, repeated cache rows, bad pages."""

from pyspark.sql import functions as F

from quirework.catalog import QUERIES
from quirework.operators import batches, site, units
from quirework.plans.ordered import LastKnown, Previous, RowNumber, RunningSum, id_bucket, ordered_scan
from quirework.session import checkpoint_dir
from quirework.sources import corpus


def test_null_keys_and_order_values_stay(spark):
    rows = [("a", 1, 10), (None, 1, 20), (None, 2, 30), ("a", None, 40), (None, None, 50)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    found = ordered_scan(df, ["k"], id_bucket("o", 1), ["o"], RowNumber("n"), RunningSum("s", F.col("v")), Previous("p", F.col("v")), LastKnown("l", F.col("v")))
    want = [("a", 1, 10, 2, 50, 40, 10), ("a", None, 40, 1, 40, None, 40), (None, 1, 20, 2, 70, 50, 20), (None, 2, 30, 3, 100, 20, 30), (None, None, 50, 1, 50, None, 50)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_one_key_with_all_rows_in_small_buckets(spark):
    df = spark.range(1000).select(F.lit("x").alias("k"), "id")
    found = ordered_scan(df, ["k"], id_bucket("id", 7), ["id"], RowNumber("n"), RunningSum("s", F.col("id")))
    assert found.filter("n <> id + 1 or s <> id * (id + 1) / 2").count() == 0 and found.count() == 1000


def test_titles_at_any_depth(spark):
    document = '{"title_en": "Deep", "title_zh": "深"}'
    for _ in range(20):
        document = '{"x": [' + document + "]}"
    found = corpus.harvest_titles(spark.createDataFrame([("p", document)], "path string, doc string"), "doc")
    assert sorted(r["title_en"] for r in found.collect()) == ["Deep", "title_zh"]


def test_tree_deeper_than_any_limit(spark):
    rows = [(i, i - 1 if i else None, i) for i in range(70)] + [(100, 101, 0), (101, 100, 0)]
    found = units.flatten_tree(spark.createDataFrame(rows, "n long, p long, o long"), "n", "p", "o").collect()
    assert sorted(r["depth"] for r in found) == list(range(70))


def test_tree_shows_unreached_nodes(spark):
    rows = [(1, None, 0), (2, 1, 0), (10, 11, 0), (11, 10, 0), (12, 11, 0), (20, 99, 0)]
    found = units.flatten_tree(spark.createDataFrame(rows, "n long, p long, o long"), "n", "p", "o", unreached=True).collect()
    assert {r["n"]: r["depth"] for r in found} == {1: 0, 2: 1, 10: None, 11: None, 12: None, 20: None}
    assert all((r["path"] is None) == (r["depth"] is None) for r in found)


def test_tree_query_keeps_rows_below_no_region(spark, tmp_path):
    spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    spark.createDataFrame([(0, "N", 0), (1, "M", 7)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    people = [(5, 0), (6, 1), (7, None)]
    spark.createDataFrame(people, "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    found = {r["id"]: (r["depth"], r["position"]) for r in QUERIES["tree_flatten"](spark, str(tmp_path)).collect()}
    none = (None, None)
    assert found == {"r0": (0, 1), "n0": (1, 2), "c5": (2, 3), "n1": none, "c6": none, "c7": (0, 4)}  # as in the SQL, a null parent makes a root


def test_slug_suffix_of_many_digits(spark):
    names = ["x", "x-12345678901", "x"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i long, base string")
    found = units.unique_slugs(df, [], "base", "i", id_bucket("i"))
    assert [r["unique_slug"] for r in found.orderBy("i").collect()] == ["x", "x-12345678901", "x-2"]


def test_one_answer_per_cached_key(spark):
    requests = spark.createDataFrame([("a",), ("b",)], "k string")
    cache = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("b", " ", 1)], "k string, answer string, latest int")
    done, missing = batches.split_cached(requests, cache, ["k"], "answer")
    assert [tuple(r) for r in done.collect()] == [("a", "new")] and [r["k"] for r in missing.collect()] == ["b"]


def test_a_bad_page_costs_no_other_page(spark):
    def extract(content):
        yield "one"
        yield ValueError("page 2")
        yield "three"
        if content == b"b":
            raise OSError("torn")

    files = spark.createDataFrame([("a", bytearray(b"a")), ("b", bytearray(b"b"))], "path string, content binary")
    found = sorted((r["path"], r["page"] or 0, r["text"], r["error"]) for r in corpus.page_texts(files, extract).collect())
    pages = [(1, "one", None), (2, "", "ValueError: page 2"), (3, "three", None)]
    assert found == [("a", *p) for p in pages] + [("b", 0, "", "OSError: torn")] + [("b", *p) for p in pages]


def test_posts_in_the_order_of_their_written_dates(spark, tmp_path):
    dates = {"a": "2024-05-01 09:00", "b": "2024-05-01 10:00", "c": "soon", "d": "2024-05-01 10:00"}
    for name, date in dates.items():
        (tmp_path / f"{name}.md").write_text(f"---\ntitle: T{name}\ndate: {date}\nslug: {name}\n---\nBody {name}.\n")
    out = f"{tmp_path}/out"
    assert site.build(spark, str(tmp_path), out, "https://x.example") == 4
    listing = "".join(r["value"] for r in spark.read.option("recursiveFileLookup", True).text(f"{out}/listing").collect())
    order = sorted("abcd", key=lambda n: listing.index(f"/posts/{n}/"))
    assert order == ["c", "b", "d", "a"]


def test_shared_folder_is_the_configured_one(spark):
    assert checkpoint_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
