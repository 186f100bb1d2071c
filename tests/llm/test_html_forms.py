"""Pages whose article hangs on end tags that are left out, or on a wrapper's class."""

import pytest

from brightledger.llm.html_extract import main_text

ONE = "The first paragraph of the article is long enough to be running text, with the words that a reader of it knows."
TWO = "And the last paragraph of the article, which is as long as the first and has as many of the words in it as any."
SIDE = "The other stories of the day are in the list of this box, which is as long as a paragraph of the article is."
ARTICLE = f"<p>{ONE}</p><p>{TWO}</p>"


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><body>{ARTICLE}",
    f"<head><meta charset=utf-8><title>T</title>{ARTICLE}",
    f"<head><title>T</title><noscript><body>{ARTICLE}",
    *(f"<body><div><{tag}>{ARTICLE}</div>" for tag in ("select", "button", "textarea", "noscript", "template", "svg")),
    f"<body><select><option>A<option>B{ARTICLE}",
])
def test_unclosed_elements_hide_nothing(page):
    assert main_text(page) == f"{ONE} {TWO}"


@pytest.mark.parametrize("tag", ["select", "button", "noscript", "template"])
def test_closed_elements_hide_their_text(tag):
    assert main_text(f"<head><title>T</title></head><body><{tag}><p>{SIDE}</p></{tag}>{ARTICLE}") == f"{ONE} {TWO}"
    assert main_text(f"<body><p>{ONE}<{tag}>{SIDE}<div>{SIDE}</div></{tag}></p><p>{TWO}</p>") == f"{ONE} {TWO}"


@pytest.mark.parametrize("attr", ["class='page has-sidebar'", "id='content-with-menu'", "class='search-result'", "class='sidebar'"])
@pytest.mark.parametrize("inner", ["{}", "<article>{}</article>", "<main>{}</main>"])
def test_a_wrapper_is_not_out(attr, inner):
    body = inner.format(ARTICLE)
    assert main_text(f"<body><div {attr}>{body}<div class='sidebar'><p>{SIDE}</p></div></div>") == f"{ONE} {TWO}"


def test_comments_longer_than_the_article_are_out():
    comments = f"<p>{SIDE}</p>" * 20
    assert main_text(f"<body>{ARTICLE}<div id='comments'>{comments}</div>") == f"{ONE} {TWO}"
    several = f"<article class='comment-body'><p>{SIDE}</p></article>" * 20
    assert main_text(f"<body><article>{ARTICLE}</article><div id='comment-list'>{several}</div>") == f"{ONE} {TWO}"


CHINESE = "这是一篇关于城市历史的长文章，" * 12
ITALIAN = "La storia della città comincia nel medioevo e continua fino ai giorni nostri con molte vicende che gli abitanti ricordano ancora oggi."
POLISH = "Historia miasta zaczyna się w średniowieczu i trwa do dziś, a wiele wydarzeń mieszkańcy pamiętają jeszcze teraz bardzo dokładnie."


def test_articles_in_any_language():
    for text in (CHINESE, ITALIAN, POLISH):
        page = f"<nav><a href=x>Home</a></nav><div><p>{text}</p><p>{text}</p></div><footer>Contact</footer>"
        assert main_text(page) == f"{text} {text}"


def test_anchors_without_a_target_are_no_links():
    text = "The first paragraph of the article is long enough to be running text with the words of it."
    assert main_text(f'<div><a name="s1"><p>{text}</p><p>{text}</p></div>') == f"{text} {text}"
    assert main_text(f'<div><p>{text}</p><p><a href="x">one<a href="y">two</a> {text}</p></div>') == f"{text} onetwo {text}"


def test_unclosed_tags_take_linear_time():
    import time

    text = "the words of the article that is here and long enough to be of the running kind of text "
    page = "<div>" + f"<b><i><span>{text}</u>" * 8000 + "</div>"
    began = time.time()
    assert len(page) > 800_000 and main_text(page).startswith(text.strip())
    assert time.time() - began < 5
