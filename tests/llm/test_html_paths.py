"""Path ratios decide the text, in time that grows with the page's length."""

import re
import time
from math import exp, sqrt

import duckdb
import pytest

from changelake.llm import html_text as ht
from changelake.llm.html_text import blocks, main_text, path_scores

PROSE = {
    "en": "The river rises in the hills, runs east for a day, and reaches the sea near the old town.",
    "fr": "La rivière naît dans les collines, coule vers l'est pendant un jour, puis gagne la mer.",
    "de": "Der Fluss entspringt in den Hügeln, fließt einen Tag nach Osten, und erreicht das Meer.",
}


def judged(page):
    found, parents, elements = blocks(page)
    return ht._judge([b for b in found if not b.boiler], parents, elements)


def test_without_scores_most_given_pages_change(sf_dir):
    pages = [r[0] for r in duckdb.sql(f"SELECT html FROM '{sf_dir}/pages.parquet'").fetchall()]
    assert pages and sum("\n".join(b.text for b in judged(p)) != main_text(p) for p in pages) > 0.5 * len(pages)


@pytest.mark.parametrize("lang", PROSE)
def test_neutral_names(lang):
    """No class, id or element says what is content."""
    text = [f"{PROSE[lang]} {i}" for i in range(6)]
    menu = "".join(f"<div class='k{i}'><a href='/{i}'>{w}</a></div>" for i, w in enumerate(PROSE[lang].split()[:8]))
    page = (f"<html><body><div class='x1'>{menu}</div><div class='x2'><h1>{PROSE[lang][:12]}</h1>"
            + "".join(f"<p>{t}</p>" for t in text[:3]) + "<div class='x5'>Top 10!</div>" + "".join(f"<p>{t}</p>" for t in text[3:])
            + "</div><div class='x3'><div class='x4'>2024</div></div></body></html>")
    assert main_text(page).split("\n") == [PROSE[lang][:12].strip(), *text]


def test_words_weigh_a_path_and_do_not_remove_it():
    """A path named 'widget' that alone has prose is the content; beside unnamed prose it is not."""
    p = "".join(f"<p>{PROSE['en']} {i}</p>" for i in range(4))
    assert len(main_text(f"<body><div class='widget'>{p}</div><div>short</div></body>").split("\n")) == 4
    both = main_text(f"<body><div class='widget'><p>{PROSE['fr']}</p></div><div class='text'>{p}</div></body>")
    assert PROSE["fr"] not in both and len(both.split("\n")) == 4


def brute(found):
    """The scores, path by path and block by block."""
    paths = [id(b.path) for b in found]
    mean = {}
    for p in set(paths):
        mine = [b for b in found if id(b.path) == p]
        marks = sum(len(re.findall(r"[.,;:!?…。，、；：！？¿¡]", b.text)) for b in mine)
        size = sum(len(b.text) for b in mine)
        weight = 1 - sum(b.links for b in mine) / size
        weight *= 1 - 0.9 * sum(len(b.text) for b in mine if b.damped) / size
        mean[p] = size / len(mine), (marks + 0.1) / len(mine), weight, len(mine)
    near = {-1: exp(-0.5), 0: 1.0, 1: exp(-0.5)}
    scores = dict.fromkeys(mean, 0.0)
    for i, p in enumerate(paths):
        there = [(w, mean[paths[i + d]]) for d, w in near.items() if 0 <= i + d < len(paths)]
        x, y = (sum(w * m[k] for w, m in there) / sum(w for w, _ in there) for k in (0, 1))
        scores[p] += sqrt(x * y) * mean[p][2] / mean[p][3]
    return scores, {p: sqrt(m[0] * m[3] * m[1] * m[3]) / m[3] * m[2] for p, m in mean.items()}


def test_scores_against_brute_force(sf_dir):
    pages = [r[0] for r in duckdb.sql(f"SELECT html FROM '{sf_dir}/pages.parquet' LIMIT 40").fetchall()]
    for page in pages:
        found = judged(page)
        for got, want in zip(path_scores(found), brute(found)):
            assert {id(p): pytest.approx(v) for p, v in got.items()} == want


HOSTILE = {
    "nested": "<div>x ", "open inline": "<span>y ", "open bold": "<b>z", "unbalanced quotes": "<a title=\"x>t ", "other quotes": "<a title='x\">t ",
    "items without lists": "<div><li>w", "closing tags": "<b><span></i></em></p>", "named": "<div class='ad share'>x", "signs": "< ", "forms": "<form>a",
}


@pytest.mark.parametrize("name", HOSTILE)
def test_time_grows_with_the_length(name):
    """Four times the page takes about four times as long; what grows with the square would take sixteen times."""
    def run(n):
        began = time.perf_counter()
        main_text(HOSTILE[name] * n)
        return time.perf_counter() - began

    run(1000)
    small = min(run(8_000) for _ in range(3))
    assert min(run(32_000) for _ in range(2)) < 9 * small + 0.2


def test_paths_share_their_starts():
    root = ht.Path(None, "", "")
    a = root
    for i in range(100):
        a = a.child(f"d{i}", "div")
    b = a.up_to(37).child("other", "p")
    assert a.shared(b) is a.up_to(37) and a.shared(root) is root and b.shared(b) is b
    assert [a.up_to(k).depth for k in range(101)] == list(range(101)) and a.up_to(5).child("d5", "div") is a.up_to(6)
