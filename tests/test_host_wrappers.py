"""What is read of a page depends on the wrapper of its host."""

from kinfold.llm import html_wrappers as hw

PAGE = "<body><h1>T</h1><p>Text of the page, long enough to be most of it, and then some more of it.</p><ul>{}</ul></body>"


def test_the_wrapper_of_a_host_decides_on_a_list():
    full = PAGE.format("".join(f"<li><a href=/{k}>link {k}</a></li>" for k in range(6)))
    short = PAGE.format("<li><a href=/1>link 1</a></li>")
    one, two = hw.infer(hw.parse(full)), hw.infer(hw.parse(short))
    host = hw.merge(hw.merge(one, hw.infer(hw.parse(full))), two)
    assert "link 1" not in hw.extract_one(short, links=frozenset(hw.linked(host)))
    assert hw.extract_one(short).endswith("\nlink 1")
    assert hw.extract_one(short, links=frozenset()).endswith("\nlink 1")
