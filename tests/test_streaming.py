"""The streamed page index."""

from gridloom.streaming.pages import page_stream, stream_page_index, table_stream


def test_no_text_is_shuffled(spark, tmp_path):
    for name in ("pages", "tables"):
        (tmp_path / name).mkdir()
    index = stream_page_index(page_stream(spark, str(tmp_path / "pages")), table_stream(spark, str(tmp_path / "tables")))
    above, below = index._jdf.queryExecution().analyzed().toString().split("Deduplicate", 1)
    assert "page_text" not in above
    assert "page_text" in below
