"""HTML extraction on very deep and unclosed pages, and on short pages."""

import time

import pytest

from rivulet.llm.html import main_text

ARTICLE = "<article><h1>Title here</h1><p>" + "Some words of the article stand here. " * 5 + "</p></article>"


@pytest.mark.parametrize("page", [
    "<div>" * 50_000 + ARTICLE, "<font>" * 50_000 + ARTICLE, "<div><span>" * 25_000 + ARTICLE, "<ul>" + "<li><div>" * 25_000 + "</ul>" + ARTICLE,
    "<div>" * 25_000 + "</section>" * 25_000 + ARTICLE, "<p>" * 50_000 + ARTICLE, "<table>" * 5_000 + "<tr><td>" * 20_000 + ARTICLE])
def test_work_does_not_grow_with_open_elements(page):
    began = time.monotonic()
    text = main_text(page)
    assert time.monotonic() - began < 5
    assert "Some words of the article stand here." in text


def test_short_pages_keep_their_text():
    assert main_text("<h1>T</h1><p>Hi.</p><p>Ok then.</p>") == "T\nHi.\nOk then."
    assert main_text("<nav><a href=x>Home</a></nav><p>Hi.</p><footer>Imprint</footer>") == "Hi."
    assert main_text("<nav><a href=x>Home</a> <a href=y>News</a></nav>") == ""
