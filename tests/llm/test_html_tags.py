"""Tags of a template are read once; how they are read does not depend on that."""

from kinfold.llm import html_wrappers as hw


def test_repeated_attributes_are_read_once():
    hw._named_before.cache_clear()
    row = '<div class="row r7" id="x"><p class=note>text</p></div>'
    page = hw.parse(row * 500)
    assert [e.label for e in page.items] == ["div[class=row r][id=x]"] * 500
    assert hw._named_before.cache_info().misses == 2


def test_odd_tags():
    read = lambda s: [t[2:] for t in hw._tags(s)]
    assert read("""<A b='>"' c=">'"/>x</a >""") == [("", "a", """ b='>"' c=">'"/"""), ("/", "a", " ")]
    assert read('<p a="1><b c=d>') == [("", "p", ' a="1'), ("", "b", " c=d")]
    assert read("<p a=<b><i") == [("", "p", " a=<b")]
    long = f'<p class="{"n1 " * 400}">'
    assert hw.parse(long).items[0].label == f'p[class={"n " * 400}]'
