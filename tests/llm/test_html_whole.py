"""Text that op4_tag_paths must not lose."""

from __future__ import annotations

import math
import random
import re
import time

import pytest

from furlens.llm import html_text

LONG = "Some words, and more of them, that go on for a while. " * 8


def test_short_inline_text_stays_in_its_sentence():
    sentence = 'See <strong><a href="/x">this page</a></strong> and<sup><a href="#n">1</a></sup> <a href="/y">here</a>, <b><a href="/z">too</a></b> it is.'
    plain = "See this page and1 here, too it is."
    for wrapped in ("<article>{}</article>", "<div>{}</div>"):
        page = wrapped.format(f"<p>{LONG}</p><p>{sentence}</p><p>{LONG * 3}</p>")
        assert html_text.main_text(f"<html><body>{page}</body></html>").split("\n")[1] == plain


def test_cells_and_link_lists_of_an_article_stay():
    page = f"<article><p>{LONG}</p><table><tr><td>a1<td>b2</table><ul><li><a href='/x'>A link of some characters</a></ul><p>{LONG}</p></article>"
    assert html_text.main_text(page).split("\n")[1:-1] == ["a1", "b2", "A link of some characters"]


def test_what_is_never_content_stays_out_of_an_article():
    page = f"<article><p>{LONG} in<span hidden>not this</span>side<nav><a href='/x'>Menu</a></nav><div class='comments'><p>{LONG * 2}</p></div></article>"
    assert html_text.main_text(page) == f"{LONG} inside".replace("  ", " ")
    assert html_text.main_text(f"<main><p>{LONG} <button>Buy</button>x</main>") == f"{LONG} x".replace("  ", " ")


def test_lists_of_links_beside_the_text_stay_out():
    links = "".join(f"<li><a href='/{i}'>word {i}</a></li>" for i in range(9))
    assert html_text.main_text(f"<body><ul>{links}</ul><div><p>{LONG}</p></div>") == LONG.strip()


def test_names_of_wrappers_do_not_empty_a_page():
    for name in ("right-sidebar", "no-sidebar", "has-sidebar", "comments-open", "sidebar", "page ad-free notice"):
        for page in ("<html class='{0}'><body>{1}", "<body class='{0}'>{1}", "<body><div id='{0}'><article>{1}</article></div>", "<body><div class='{0}'><div>{1}</div></div>", "<body><div class='{0}'><main>{1}</main></div>"):
            assert html_text.main_text(page.format(name, f"<p>{LONG}</p>")) == LONG.strip(), (name, page)


def test_form_around_a_page():
    for page in ("<body><form action='/'><div><p>{0}</p></div><input></form>", "<body><form role='form'><article><p>{0}</p><form class='search'>Go</form></article></form>"):
        assert html_text.main_text(page.format(LONG)) == LONG.strip()


def test_asides_keep_being_left_out():
    asides = "<div class='sidebar-left'><p>{0}</p></div><div class='cookie_bar'><p>{0}</p></div><ul class='nav__list'><li>{0}</ul><form><p>{0}</p></form>".format("Short, but text. It is.")
    comments = f"<div id='comments' class='comments-area'><ol class='comment-list'><li><article class='comment-body'><p>{LONG}</p></article></ol></div>"
    page = f"<body class='has-sidebar'>{asides}<div class='sidebar'><aside><article>Teaser</article></aside></div><article><p>{LONG * 3}</p></article>{comments}"
    assert html_text.main_text(page) == (LONG * 3).strip()
    assert html_text.main_text(f"<article><p>{LONG}</p><div class='comments'><p>{LONG * 5}</p></div></article>") == LONG.strip()


def test_parts_inside_names_do_not_count():
    page = f"<article><p>{LONG}</p><p class='lead-ad-text'>One.</p><div class='with-sidebar'><p>Two.</p></div></article>"
    assert html_text.main_text(page).split("\n")[1:] == ["One.", "Two."]


def test_tables_and_link_lists_between_the_text_stay():
    page = f"<div><p>{LONG}</p><table><tr><td>a1<td>b2</table><ul><li><a href='/x'>One link</a></ul><p>{LONG}</p></div>"
    for wrapped in (page, f"<body><ul><li><a href='/m'>Menu</a></ul>{page}<p>me"):
        assert html_text.main_text(wrapped).split("\n") == [LONG.strip(), "a1", "b2", "One link", LONG.strip()]
    at_the_end = f"<body><div><h2>Top</h2><p>{LONG}</p><p>{LONG}</p><ul><li><a href='/x'>One link</a></ul></div><ul><li><a href='/m'>Menu</a></ul>"
    assert html_text.main_text(at_the_end).split("\n") == ["Top", LONG.strip(), LONG.strip(), "One link"]


def test_names_that_only_begin_like_asides_stay():
    page = f"<article><p>{LONG}</p><p class='comment-free'>A sentence here.</p><p id='ad-hoc'>Ad hoc rule.</p><div class='ad-1'>Buy</div><div class='comments-area'>Nice</div></article>"
    assert html_text.main_text(page).split("\n") == [LONG.strip(), "A sentence here.", "Ad hoc rule."]


def test_names_outside_the_contract_stay_in_an_article():
    for name in html_text.OUTER_WORDS:
        assert html_text.main_text(f"<article><p>{LONG}</p><div class='{name}'>Inner.</div></article>").endswith("Inner."), name


def test_text_beside_an_article_goes():
    page = f"<body><article><h1>Title</h1><p>{LONG}</p></article><div class='related-posts'><p>{LONG}</p></div>"
    assert html_text.main_text(page).split("\n") == ["Title", LONG.strip()]
    teaser = f"<body><div class='story'>Teaser</div><div><p>{LONG}</p><p>{LONG}</p></div>"
    assert LONG.strip() in html_text.main_text(teaser)


def test_header_of_an_article_goes_with_its_title():
    assert html_text.main_text(f"<article><header><h1>Title</h1></header><p>{LONG}</p></article>") == LONG.strip()


@pytest.mark.parametrize("part", ["<div>w", "<b>w", "<a ", '<a x="', '<a ">"', "<a x=\"'>", "<!x ", "<", "</script ", "<script>x</script ", "<p><table><h1>", "<li></li><h1>", "<tr><td>x", "<dl><dd>", "<td><table><li></li>", "&amp"])
def test_hostile_markup_takes_time_in_proportion(part):
    started = time.process_time()
    html_text.main_text(part * (1_000_000 // len(part)))
    assert time.process_time() - started < 30


def test_ends_of_tags():
    page = """<a x="1>2" y='>'>b "c" 'd" > e"""
    for at in range(len(page) + 1):
        quoted = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*+>""").match(page, at)
        found = quoted.end() - 1 if quoted else page.find(">", at)
        assert html_text.Tags(page).end(at) == found, at


# A second, plain way over whole trees: (tag, class, children), where a child is a tree or a text.


def plainly(tree):
    def size(t):
        return len(t.strip()) if isinstance(t, str) else sum(map(size, t[2]))

    def holds(t):  # an article or main that is not ruled out
        if isinstance(t, str) or ruled_out(t):
            return False
        return t[0] in ("article", "main") or any(map(holds, t[2]))

    everything = size(tree)
    articles = set()

    def mark(t, inside):
        if not isinstance(t, str):
            if inside:
                articles.add(id(t))
            for child in t[2]:
                mark(child, inside or t[0] == "article")

    mark(tree, False)

    def ruled_out(t):
        if t[0] in ("nav", "aside"):
            return True
        named = t[1] == "sidebar" and t[0] != "body"
        return named and not any(map(holds, t[2])) and not (size(t) > everything / 2 and id(t) not in articles)

    texts = []  # path of block tags, weight, text, elements from the root, number of its block
    block = [0]

    def walk(t, path, weight, line):
        path = path + (t[0],) if t[0] != "b" else path
        weight = 0 if weight == 0 or ruled_out(t) else max(weight, 8 if t[0] in ("article", "main") else 1)
        if t[0] != "b":
            block[0] += 1
        for child in t[2]:
            if isinstance(child, str):
                texts.append((path, weight, child, (*line, t), block[0]))
            else:
                walk(child, path, weight, (*line, t))
        if t[0] != "b":
            block[0] += 1

    walk(tree, (), 1, ())
    filled = [x for x in texts if x[2].strip()]
    in_main = sum(len(x[2].strip()) for x in filled if x[1] == 8)
    if in_main and in_main >= 0.2 * sum(len(x[2].strip()) for x in filled if x[1]):
        kept = [x[1] == 8 for x in filled]
    else:
        fused = {}
        for path, weight in {x[:2] for x in filled}:
            mine = [x for x in filled if x[:2] == (path, weight)]
            n = len({x[4] for x in mine})
            marks = sum(x[2].count(".") + x[2].count(",") for x in mine)
            fused[path, weight] = weight * (math.log1p(sum(len(x[2].strip()) for x in mine) / n) + math.log1p(marks / n))

        def mean(path, depth):
            same = [v for (p, w), v in fused.items() if w and p[:-depth] == path[:-depth]]
            return sum(same) / len(same)

        value = {(p, w): 0.5 * v + 0.3 * mean(p, 1) + 0.2 * mean(p, 2) if w else 0 for (p, w), v in fused.items()}
        least = 0.2 * max(value.values(), default=0)
        kept = [x[1] == 8 or value[x[:2]] >= least and x[1] > 0 for x in filled]
        total = sum(len(x[2].strip()) for x, k in zip(filled, kept) if k)
        if total:
            candidates = {id(e): e for x in filled for e in x[3] if e[0] in ("body", "div", "section")}
            share = {i: sum(len(x[2].strip()) for x, k in zip(filled, kept) if k and i in map(id, x[3])) for i in candidates}
            depth = {i: max(list(map(id, x[3])).index(i) for x in filled if i in map(id, x[3])) for i in candidates}
            holder = max((i for i in candidates if share[i] >= 0.9 * total), key=depth.get)
            direct = 0
            for x, k in zip(filled, kept):
                if k and holder in map(id, x[3]):
                    below = x[3][list(map(id, x[3])).index(holder) + 1 :]
                    outermost = [i for i, e in enumerate(below) if e[0] != "b"]
                    if len(outermost) <= 1 or all(below[i][0] == "b" for i in range(outermost[0] + 1, len(below))):
                        direct += len(x[2].strip())
            inside = [holder in map(id, x[3]) and x[1] > 0 for x in filled]
            if candidates[holder][0] == "body" or 2 * direct < total:
                places = [i for i, (k, y) in enumerate(zip(kept, inside)) if k and y]
                inside = [y and places[0] <= i <= places[-1] for i, y in enumerate(inside)]
            kept = [k or y for k, y in zip(kept, inside)]
    lines = {}
    for x, k in zip(filled, kept):
        if k:
            lines.setdefault(x[4], []).append(x[2])
    return "\n".join(" ".join("".join(t).split()) for t in lines.values())


def random_tree(rng, depth=0, tag="body"):
    children = []
    for _ in range(rng.randint(1, 5)):
        kind = rng.random()
        if tag in ("p", "b") or depth > 4 or kind < 0.35:
            text = "w" * rng.randint(1, 9) + ". " + "many words, so it goes. " * rng.choice([0, 0, 1, 4, 12])
            if children and isinstance(children[-1], str):
                text = children.pop() + text  # as the page reads
            children.append(text)
        else:
            child = rng.choice(["div", "div", "section", "p", "p", "b", "article", "main", "nav", "aside"] if rng.random() < 0.3 else ["div", "section", "p", "p", "b"])
            children.append(random_tree(rng, depth + 1, child))
    if tag == "b":
        children = ["".join(c for c in children if isinstance(c, str)) or "x. "]
    return (tag, rng.choice([None, None, None, "sidebar", "ad-hoc"]), children)


def markup(t):
    return t if isinstance(t, str) else f"<{t[0]}" + (f" class='{t[1]}'" if t[1] else "") + ">" + "".join(map(markup, t[2])) + f"</{t[0]}>"


def test_random_trees_against_a_plain_way():
    rng = random.Random(5)
    for _ in range(1500):
        tree = random_tree(rng)
        assert html_text.main_text(markup(tree)) == plainly(tree), markup(tree)
