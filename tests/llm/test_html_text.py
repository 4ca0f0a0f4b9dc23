"""Pages whose content stands in more than one element."""

import pytest

from changelake.llm.html_text import main_text

PROSE = "Paragraph {}, with a good number of words in it, so that it reads as prose."
TEXTS = [PROSE.format(i) for i in range(8)]
P = [f"<p>{t}</p>" for t in TEXTS]
LONG = "A long entry, with many marks; much longer than a paragraph of this page. " * 12


def texts(body):
    return main_text(f"<html><body>{body}</body></html>").split("\n")


def test_nested_sections_keep_lead_and_title():
    page = f"<article><h1>Title</h1>{P[0]}<section><h2>One</h2>{P[1]}{P[2]}</section><section>{P[3]}{P[4]}</section></article>"
    assert texts(page) == ["Title", TEXTS[0], "One", *TEXTS[1:5]]


@pytest.mark.parametrize("one, two", [("div class='a'", "div class='b'"), ("section id='x'", "section id='y'"), ("article", "section")])
def test_siblings_are_all_kept(one, two):
    page = f"<{one}><h1>Title</h1>{P[0]}{P[1]}</{one.split()[0]}><{two}>{P[2]}{P[3]}{P[4]}</{two.split()[0]}><div class='end'>Made by X</div>"
    assert texts(page) == ["Title", *TEXTS[:5]]


@pytest.mark.parametrize("heavy", [
    "<ul>" + f"<li>{LONG}</li>" * 3 + "</ul>", f"<blockquote>{LONG * 3}</blockquote>", f"<blockquote><p>{LONG * 3}</p></blockquote>",
    "<table>" + f"<tr><td>{LONG}</td><td>5</td></tr>" * 3 + "</table>"])
@pytest.mark.parametrize("wrap", ["{}", "<div class='text'>{}</div>"])
def test_a_heavy_list_quote_or_table_leaves_the_paragraphs(heavy, wrap):
    got = texts(f"<article><h1>Title</h1>{wrap.format(P[0] + P[1])}{heavy}{P[2]}<p>Short one</p></article>")
    assert got[:3] == ["Title", *TEXTS[:2]] and got[-2:] == [TEXTS[2], "Short one"]
    assert sum(t.startswith("A long entry") for t in got) in (1, 3)


def test_low_paths_and_links_are_dropped_inside_the_article_too():
    page = (f"<div><h3>Tags</h3><ul><li><a href='x'>one</a></li></ul></div><article><h1>Title</h1>{P[0]}<div class='more'>Read more</div>"
            f"{P[1]}<ul><li>short</li><li>item</li></ul>{P[2]}</article><div><h3>Latest</h3><p><a href='x'>Another page</a></p></div>")
    assert texts(page) == ["Title", *TEXTS[:2], "short", "item", TEXTS[2]]


def test_items_after_a_dropped_link_stay_and_what_follows_the_article_does_not():
    page = (f"<p>A tagline</p><div class='text'><h1>Title</h1>{P[0]}{P[1]}<ul><li>short</li><li><a href='x'>a link</a></li><li>item</li></ul>"
            f"<h2>Next</h2>{P[2]}</div><p>Made by X</p>")
    assert texts(page) == ["Title", *TEXTS[:2], "short", "item", "Next", TEXTS[2]]


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div id='page'><div class='text'>{}</div><div>By X</div></div>"])
def test_words_of_class_and_id_leave_the_content_whole(wrap):
    page = (f"<h1 class='header'>Title</h1>{P[0]}<h2 id='related-work'>Related work</h2>{P[1]}<section id='social-structure'>{P[2]}</section>"
            f"<p class='notice-period'>{TEXTS[3]}</p><div class='search-methods'>{P[4]}</div><section id='replies-to-critics'>{P[5]}</section>"
            f"<div class='related-posts'><p>Another page, about something else, that is good to read.</p></div>{P[6]}"
            "<section id='comments'><p>A reader says this, at some length, and it is no part of the text.</p></section>")
    assert texts("<div class='cookie-notice'><p>We use cookies, of course, as all do.</p></div>" + wrap.format(page)) == [
        "Title", TEXTS[0], "Related work", *TEXTS[1:7]]


def test_a_form_around_the_page_is_no_form():
    page = f"<nav><p>A menu, of a kind, with words.</p></nav><article><h1>Title</h1>{P[0]}{P[1]}</article><form><p>Your name, please.</p></form>"
    assert texts(f"<form id='aspnet'>{page.replace('form', 'fieldset')}</form>") == texts(page) == ["Title", *TEXTS[:2]]
