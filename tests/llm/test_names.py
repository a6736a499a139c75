"""Columns to be read that have the names of results, and empty tables."""

import pytest

from tablecontract.llm import language, pages, urls, warc


def test_columns_named_like_results_are_refused(spark):
    frame = spark.createDataFrame([("x", "y", "z")], "Score string, verdict string, block string")
    for run in (
        lambda: language.predict(frame, {}, text="Score"),
        lambda: urls.filter_urls(frame, {"org/": "allow"}, url="verdict"),
        lambda: warc.derive(frame, key=warc.RECORD[0].name.upper()),
    ):
        with pytest.raises(ValueError, match="name of a result"):
            run()


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert pages.extract(none).count() == 0
    assert warc.derive(warc.responses(none)).count() == 0
    assert urls.filter_urls(none, {"org/": "allow"}).count() == 0
    assert language.predict(none, {}, text="html").count() == 0
