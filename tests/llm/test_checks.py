"""Queries that have check SQL, against it, on whole tables."""

import pytest

from millwright.llm.check_sql import oracle
from millwright.llm.queries import registry
from tests.compare import connect, differences
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(oracle()))
def test_query_matches_check(spark, name):
    assert differences(registry()[name](spark, SMALL), connect(SMALL), oracle()[name]) == []


def test_linked_pages_match_the_check(spark, tmp_path):
    """The given pages name no other address; these do, in a chain, by both kinds of link."""
    pages = [
        (1, "http://plain.test/a", '<link rel="canonical" href="https://www.shop.net/es/x">'),
        (2, "http://other.test/b?utm_x=1", '<meta http-equiv="refresh" content="0; url=http://plain.test/a/">'),
        (3, "http://alone.test/c", None), (4, None, "<p>"), (5, "no address", ""), (6, "http://plain.test/a#x", ""),
        (7, "http://moved.test/d", '<link href="//shop.net/fr/q" rel=canonical>'),
        (8, "http://safe.test/e", '<meta http-equiv=refresh content="0;url=/f">'),
        (9, "http://safe.test/f", '<link rel="canonical" href="http://a.com/">'),
        (9, "http://safe.test/f", '<link rel="canonical" href="http://a.net/es/">'),
    ]
    path = str(tmp_path / "pages.parquet")
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(path)
    check = connect(str(tmp_path))
    check.execute(f"create or replace view pages as select * from '{path}/*.parquet'")
    found = registry()["op5_urls"](spark, str(tmp_path))
    assert differences(found, check, oracle()["op5_urls"]) == []
    verdicts = {r["page_id"]: r["verdict"] for r in found.collect()}
    assert verdicts == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "block", 7: "block", 8: "allow",
                        9: "allow"}
