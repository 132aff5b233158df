import json

from paperloom.plans.pipeline import convert
from paperloom.settings import Settings
from paperloom.sources.staging import read_block_lists

from tests.test_operators import blocks, papers


def test_a_volume_is_converted_like_any_other_paper(spark):
    volume = blocks(spark, [{"type": "text", "text": f"Page {i} tells of the sample.", "page_idx": i} for i in range(301)])
    got = {r.page_idx: r.body for r in convert(volume, papers(spark)).collect()}
    assert sorted(got) == list(range(301)) and "Page 300 tells" in got[300]
    assert convert(volume, papers(spark), Settings(max_pages=300)).count() == 0
    assert convert(volume, papers(spark), Settings(max_pages=301)).count() == 301


def test_a_volume_is_read_whole(spark, tmp_path):
    folder = tmp_path / "volume"
    folder.mkdir()
    (folder / "x_content_list.json").write_text(json.dumps([{"type": "text", "text": "a", "page_idx": i} for i in range(301)]))
    assert read_block_lists(spark, str(tmp_path / "*" / "*_content_list.json")).count() == 301
