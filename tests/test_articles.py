"""Article queries over orders of their own: two zones, numbers and rows that come twice, customers that are missing."""

import datetime

import pytest

from lexanchor.plans.registry import QUERIES

#: Documents 0 to 3: a second zone and an article that comes twice, no second zone, a first article that comes twice, numbers that begin anew without one.
KEYS = [*range(400), 16, *range(400, 720), *range(800, 840), 800, *range(1208, 1600)]


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("articles"))
    day = datetime.datetime(2020, 1, 5)
    rows = [(k, None if k % 3 == 1 else k % 97, "F", 1.0, day, "1-URGENT") for k in KEYS]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(rows, schema).write.parquet(f"{at}/orders.parquet")
    return at


def articles():
    """Article lines open every eighth order and count to 40; the second zone begins with the second line of article 1."""
    rows = sorted((key // 400, key % 400 * 8, str(1 + key % 400 // 8 % 40)) for key in KEYS if key % 8 == 0)
    starts = {}
    for doc, pos, value in rows:
        if value == "1":
            starts.setdefault(doc, []).append(pos)
    return [(doc, pos, value, "adct" if len(starts[doc]) > 1 and pos >= starts[doc][1] else "cf") for doc, pos, value in rows]


def found(spark, name, at):
    df = QUERIES[name](spark, at)
    assert df.columns == ["doc_id", "pos", "value", "namespace"]
    return sorted(tuple(r) for r in df.collect())


def test_articles_have_the_namespace_of_their_zone(spark, orders):
    want = articles()
    assert {(doc, ns) for doc, _, _, ns in want} == {(0, "cf"), (0, "adct"), (1, "cf"), (2, "adct"), (3, "cf")}
    assert found(spark, "win10_namespace_of", orders) == want


def test_only_the_first_line_of_an_article_is_accepted(spark, orders):
    seen, want = set(), []
    for doc, pos, value, namespace in articles():
        if (doc, namespace, value) not in seen:
            seen.add((doc, namespace, value))
            want.append((doc, pos, value, namespace))
    assert 0 < len(articles()) - len(want) and (3, 328 * 8, "2", "cf") in articles() and (3, 328 * 8, "2", "cf") not in want
    assert found(spark, "win11_accept_first", orders) == want
