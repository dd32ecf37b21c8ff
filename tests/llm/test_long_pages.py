"""Pages and notices whose handling must stay linear in their length."""

import time

import pytest

from heliovane.llm import htmltext, licenses


@pytest.mark.parametrize(
    "page",
    ["<a" * 100_000, "<b x " * 50_000, "<div>" * 50_000, "<div>x" * 20_000, "<p>one</p>" * 100_000 + "<a" * 50_000, "<!-- " * 100_000, "<svg>" * 50_000, "<a" * 100_000 + ">", "word " * 1_000_000,
     "</div>" * 100_000, "<td>" * 50_000, "<div><p>" * 20_000 + "</p></div>" * 20_000],
)
def test_no_page_takes_long(page):
    began = time.process_time()
    htmltext.blocks(page)
    assert time.process_time() - began < 6


def test_comments_and_what_follows_the_last_tag():
    texts = lambda page: [b.text for b in htmltext.blocks(page)]
    assert texts("<p>one</p><!--><p>two</p><!-- x --><p>three</p>") == ["one", "two", "three"]
    assert texts("<p>one</p><!-- never <p>closed</p>") == ["one"]
    assert texts("<p>one</p>tail <b") == ["one", "tail <b"] and texts("a < b") == ["a < b"]
    assert texts("<p>one</p><!-- cut") == texts("<p>one</p><!-- cut <p>off</p> tail") == texts("<p>one</p><script>x = '</p>' tail") == ["one"]
    assert texts("<p>one</p><script>x</script> tail") == texts("<p>one</p><!-- x --> tail") == texts("<p>one</p><!--> tail") == ["one", "tail"]


def test_many_notices_in_one_text():
    text = b"all rights reserved filler word " * 200_000 + b"released under the mit license"
    began = time.process_time()
    n_words, n_base, first, last, *_, spans = licenses._scanner().scan(text)
    assert time.process_time() - began < 60
    assert (n_words, n_base, first, last) == (1_000_005, 1, 1_000_003, 1_000_003)
    assert all(spans[i]["first_word"] < spans[i + 1]["first_word"] for i in range(len(spans) - 1)) and spans[0]["first_word"] == 0
