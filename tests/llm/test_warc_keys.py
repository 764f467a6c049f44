"""URL keys in SQL, by which runs are sorted, equal those that are read back."""

from pyspark.sql import functions as F
from sparkmart.llm.warc import _UNSAFE, archive_pages, url_key, url_key_of

URLS = [
    None, "", "http://www.A.example.com/x?y=1#part", "https://b.org", "ftp://u@h.de:21/a b", "no url",
    "http://c.net/\ttab", "http://www.www.d.com/?q", "HTTP://E.F/é", "x://#f", "http://g.h/a\nb", " http://i.j/",
]


def test_keys_agree(spark):
    found = spark.createDataFrame([(u,) for u in URLS], "url string").select(url_key_of(F.col("url")))
    safe = [None if u is None else _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", u) for u in URLS]
    assert [row[0] for row in found.collect()] == [url_key(u) for u in safe]


def test_urls_with_spaces_stand_in_order(spark):
    rows = [(n, URLS[n % len(URLS)], f"page {n % 5}") for n in range(60)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = archive_pages(pages.repartition(4)).orderBy("index_position").collect()
    keys = [(row["url_key"], row["page_id"]) for row in found]
    assert keys == sorted(keys) and len(keys) == 60
