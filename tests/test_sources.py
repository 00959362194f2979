from voxloom.functions import lexicon
from voxloom.sources import search


def test_search_pages_until_the_limit(spark):
    rows = search.search(spark, ["talks", "news"], 70).collect()
    assert len(rows) == 140 and len({r["video_id"] for r in rows}) == 140
    assert [r["title"] for r in rows if r["title"].startswith("talks")][:2] == ["talks 0", "talks 1"]
    assert len(list(search.pages("x", 500))) == 120 and list(search.pages("x", 0)) == []


def test_lexicon(spark):
    assert lexicon.entity_types(spark, ["order id", "City"]).where("tag in ('ENTITY_ORDER_ID', 'ENTITY_CITY')").count() == 2
    assert lexicon.codes(spark).where("kind = 'gender/binary'").count() == 1 and lexicon.intents(spark).count() == 10
