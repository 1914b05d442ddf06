"""Wrappers of hosts: deep nesting, names without meaning, layouts, copies, and merges over tasks."""

from __future__ import annotations

import json
import random

import pytest

from tenure.llm import wrappers
from tenure.llm.wrappers import extract, infer, packed, rules, unpacked


@pytest.mark.parametrize("tag", ["div", "td"])
@pytest.mark.parametrize("depth", [10, 70, 200])
def test_deep_levels_are_closed_and_their_menus_told_apart(tag, depth):
    start, end = f"<table><tr><{tag}>" if tag == "td" else "<div>", f"</{tag}></tr></table>" if tag == "td" else "</div>"

    def page(i):
        deep = f"<p>inner {i}</p><nav>home</nav><form><div>ask</div></form><div class='sidebar'><div>ad</div></div><p>more {i}</p>"
        return f"<body><div id='a'><article><p>first {i}</p>{start * depth}{deep}{end * depth}<p>last {i}</p></article></div><div>foot {i}</div></body>"

    pages = [page(i) for i in range(4)]
    assert extract(pages[2], rules(infer(pages))) == "first 2 inner 2 more 2 last 2"


def test_very_deep_pages_of_any_names_do_not_fail():
    for tag in ("<div>", "<article>", "<nav>", "<div class='ad'>", "<header><h1>"):
        page = tag * 5000 + "deep"
        extract(page, rules(infer([page, page + " too"])))


def prose(seed, n=40):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8))) for _ in range(n)) + "."


def plain(i):
    """A layout whose names tell nothing: menu, notice, article, footer."""
    links = "".join(f"<li><a href=/{i}{k}>{prose(f'l{i}{k}', 2)}</a></li>" for k in range(4))
    return (
        f"<body><div class=x1><ul>{links}</ul></div><div class=x2>We use cookies on this site.</div>"
        f"<div class=x3><h2>{prose(f'h{i}', 5)}</h2><p>{prose(f'a{i}')}</p><p>Read on below.</p><p>{prose(f'b{i}')}</p></div>"
        f"<div class=x4>All rights kept.</div></body>"
    )


def plain_text(i):
    return f"{prose(f'h{i}', 5)} {prose(f'a{i}')} {prose(f'b{i}')}"


def bare(i):
    """Another layout, of elements without any names; the notice stands beside the text."""
    return f"<body><table><tr><td><p>{prose(f'c{i}')}</p><div>Prices may change at any time.</div><p>{prose(f'd{i}')}</p></td></tr></table></body>"


def bare_text(i):
    return f"{prose(f'c{i}')} {prose(f'd{i}')}"


@pytest.mark.parametrize("n", [3, 12, 40])
def test_menus_and_notices_without_names_are_left_out(n):
    found = rules(infer([plain(i) for i in range(n)]), counted([plain(i) for i in range(n)]))
    assert [extract(plain(i), found) for i in range(n)] == [plain_text(i) for i in range(n)]
    # A page alone cannot tell that its notice is one.
    assert "Read on below." in extract(plain(1), None)


def counted(pages):
    """Shares of pages by place and text, by brute force."""
    trees = {wrappers._words(t): t for t in map(wrappers.parse, pages)}.values()
    places = [{(wrappers._place(path), wrappers._digest(slot.text)) for path, slot in wrappers._slots(t)} for t in trees]
    out = {}
    for place, text in set().union(*places):
        n = sum((place, text) in own for own in places)
        of = sum(any(p == place for p, _ in own) for own in places)
        if n >= wrappers.LEAST_PAGES and n >= wrappers.MOSTLY * of:
            out[place, text] = n / of
    return out


def test_a_host_of_two_layouts_and_copies(spark):
    pages = [plain(i) for i in range(8)] + [bare(i) for i in range(5)]
    texts = [plain_text(i) for i in range(8)] + [bare_text(i) for i in range(5)]
    rows = [(k, f"http://one.test/{k}", p) for k, p in enumerate(pages)]
    # Copies of one page do not make its text a template; a single page of a host is judged by itself.
    rows += [(100 + k, f"http://ONE.test/copy{k}", pages[2]) for k in range(30)] + [(200, "http://two.test/", bare(77))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    out = {r["page_id"]: r["text"] for r in wrappers.main_text(df).collect()}
    assert [out[k] for k in range(13)] == texts
    assert {out[100 + k] for k in range(30)} == {texts[2]}
    assert out[200] == f"{prose('c77')} Prices may change at any time. {prose('d77')}"


def test_columns_of_the_same_names_and_many_parts_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "FAN", 2)
    rows = [(k, f"http://h{k % 2}.test/{k}", plain(k), "x", 1) for k in range(24)] + [(50, "http://h0.test/", "<p>" + "long words " * 60_000, "x", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, place long").repartition(9)
    out = {r["page_id"]: r["text"] for r in wrappers.main_text(df).collect()}
    assert [out[k] for k in range(24)] == [plain_text(k) for k in range(24)]
    assert len(out[50]) == 660_000 - 1


def test_names_only_break_ties():
    def page(i, name, tag="p"):
        return f"<body><div class=y><p>{prose(i)}</p><{tag} class={name}>{prose(f'n{i}', 8)}</{tag}><p>{prose(f'z{i}')}</p></div></body>"

    for name in ("legal", "alert", "share"):
        assert prose("n3", 8) in extract(page(3, name), rules(infer([page(i, name) for i in range(6)])))
    for name in ("related-content", "newsletter-content", "comment-content", "footer-content", "ad-content"):
        assert prose("n3", 8) not in extract(page(3, name, "div"), rules(infer([page(i, name, "div") for i in range(6)])))
    bulk = "<body><p>top</p><div class=related-content><p>{}</p><p>{}</p></div></body>"
    assert prose(1) in extract(bulk.format(prose(1), prose(2)), None)


def test_near_copies_of_one_article_are_no_template(spark):
    rows = [(k, f"http://n.test/{k}", f"<body><div><p>{prose('same')}</p><p>{prose('too')}</p><p>{k}</p></div></body>") for k in range(9)]
    out = wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r["text"] == f"{prose('same')} {prose('too')} {r['page_id']}" for r in out)


def test_wrappers_survive_being_written():
    wrapper = infer([plain(i) for i in range(5)] + [bare(1)])
    assert packed(unpacked(json.loads(json.dumps(packed(wrapper))))) == packed(wrapper)


def seldom(i):
    """A layout of few pages: on most the first block is the article, on the last the second one holds more."""
    long, short = prose(f"s{i}", 60), prose(f"t{i}", 3)
    if i == 6:
        long, short = short, prose("aside", 30)
    return f"<body><section class=qa><div class=qb><p>{long}</p><p>{prose(f'u{i}', 4)}</p></div><div class=qc><p>{short}</p></div></section></body>"


@pytest.mark.parametrize("parts", [1, 5])
def test_elements_of_few_pages_of_a_large_host_are_not_lost(spark, parts):
    many = 2000
    pages = [plain(i) for i in range(many)]
    for i in range(7):
        pages[many - 1 - i * 150] = seldom(i)
    at = many - 1 - 6 * 150
    whole = rules(infer(pages), {})
    expected = extract(seldom(6), whole)
    assert expected == f"{prose('t6', 3)} {prose('u6', 4)}" and prose("aside", 30) in extract(seldom(6), None)
    df = spark.createDataFrame([(k, f"http://big.test/{k}", p) for k, p in enumerate(pages)], "page_id long, url string, html string")
    out = {r["page_id"]: r["text"] for r in wrappers.main_text(df.repartitionByRange(parts, "page_id")).collect()}
    assert out[at] == expected
    assert all(out[k] == plain_text(k) for k in range(0, many, 40) if pages[k] == plain(k))


def test_what_is_set_apart_and_the_wrapper_hold_all_letters():
    pages = [plain(i) for i in range(600)] + [seldom(i) for i in range(2)]
    wrapper, rest = None, {}
    for page in pages:
        tree = wrappers.folded(wrappers.parse(page))
        wrapper = tree if wrapper is None else wrappers.joined(wrapper, tree, None, rest)
    whole, own = infer(pages), rules(wrapper, {}).wrapper
    total = rules(whole, {}).wrapper
    assert (own.letters, own.link_letters) == (total.letters, total.link_letters)
    section = next(c for body in total.children for c in body.children if c.key == "section.qa")
    assert rest[wrappers._place(("body", "section.qa"))] == [2, section.letters, section.link_letters, False]


def test_what_one_part_keeps_and_another_sets_apart_is_one_sum():
    def late(i, first, second):
        return f"<body><section class=qa><div class=qb><p>{prose(f'v{i}', first)}</p></div><div class=qc><p>{prose(f'w{i}', second)}</p></div></section></body>"

    parts = [[late(i, 3, 30) for i in range(100)], [plain(i) for i in range(300)] + [late(i, 120, 1) for i in range(100, 200)]]
    made, rest = [], {}
    for pages in parts:
        wrapper = None
        for page in pages:
            tree = wrappers.folded(wrappers.parse(page))
            wrapper = tree if wrapper is None else wrappers.joined(wrapper, tree, None, rest)
        made.append(wrapper)
    found = rules(wrappers.joined(*made, None, rest), {})
    whole = rules(infer(parts[0] + parts[1]), {})
    assert extract(parts[0][5], whole) == prose("v5", 3)
    assert extract(parts[0][5], found, rest) == prose("v5", 3)
    assert extract(parts[0][5], found) == prose("w5", 30)
    assert [extract(p, found, rest) for p in parts[1][::20]] == [extract(p, whole) for p in parts[1][::20]]
