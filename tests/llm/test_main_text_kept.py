"""What the main text must keep: articles in containers with layout names, forms, and siblings."""

import pytest

from hearth.llm import html_text

A = "The first part of the story, told at length, with commas, and enough words to count as a paragraph of its own."
B = "The second part of the story, as long as the first, with commas too, and words enough to count as one as well."
MENU = '<div class="sidebar"><ul><li><a href="/">Home</a><li><a href="/x">Other</a></ul></div>'


@pytest.mark.parametrize("name", [
    "no-sidebar", "has-sidebar content", "post comments-open", "elementor-widget elementor-widget-text-editor"])
@pytest.mark.parametrize("tag", ["div", "article", "section"])
def test_layout_names_are_not_cut(name, tag):
    assert html_text.main_text(f'<body>{MENU}<{tag} class="{name}"><p>{A}</p><p>{B}</p></{tag}>') == f"{A}\n{B}"


@pytest.mark.parametrize("name", [
    "ad", "ad-slot", "sidebar", "widget widget_text", "site-footer", "cookie-notice", "comments-area", "related-posts",
    "share_buttons", "nav-menu", "breadcrumbs", "header-top", "sidebar__inner"])
def test_named_parts_are_cut(name):
    page = f'<div class="post"><p>{A}</p><p>{B}</p></div><div class="{name}"><p>Buy this, now, please.</p></div>'
    assert html_text.main_text(page) == f"{A}\n{B}"


@pytest.mark.parametrize("inner", [
    f"<p>{A}</p><p>{B}</p>", f"<div><p>{A}</p><p>{B}</p></div>", f"<article><p>{A}</p><p>{B}</p></article>",
    f"<main><p>{A}</p><p>{B}</p></main>", f"<div>{A}</div><div>{B}</div>"])
@pytest.mark.parametrize("outer", ['<form id="aspnetForm">{}</form>', '<div class="header">{}</div>',
                                   '<div class="widget"><form>{}</form></div>'])
def test_a_form_or_named_container_around_the_page(inner, outer):
    assert html_text.main_text(f"<body>{outer.format(MENU + inner)}</body>") == f"{A}\n{B}"


def test_small_forms_and_teasers_beside_the_article_are_cut():
    page = (f"<body><article><p>{A}</p><p>{B}</p></article><form><p>Write to us, please, now.</p></form>"
            '<div class="related-posts"><article><p>Another story, in short.</p></article></div>'
            f'<div class="comments"><p>{A}</p><p>{B}</p><p>{A}</p></div>')
    assert html_text.main_text(page) == f"{A}\n{B}"


def test_formulas_stay():
    page = (f"<article><p>{A}</p><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation encoding='application/x-tex'>"
            "x=1</annotation></math> holds.</p></article>")
    assert html_text.main_text(page) == f"{A}\nSo x=1 holds."


def test_long_names_and_deep_forms_are_linear():
    page = '<div class="' + "nav-" * 50_000 + 'x">' + f"<p>{A}</p></div>" + "<form>" * 3000 + f"<p>{B}</p>" * 2
    assert B in html_text.main_text(page)
    assert html_text.main_text(f"<p>{A}</p>" + "<b class='ad'>" * 20_000 + "x") == A


@pytest.mark.parametrize("page, text", [
    (f"<main><article><p>{A}</p></article><article><p>{B}</p></article></main>", f"{A}\n{B}"),
    (f"<body><article><p>{A}</p></article><article><p>{B}</p></article><p>out</p></body>", f"{A}\n{B}\nout"),
    (f"<main><h1>Title</h1><article><p>{A}</p></article><section><p>{B}</p></section></main>", f"Title\n{A}\n{B}"),
    (f"<main><h1>Title</h1><div><article><p>{A}</p></article></div><section><p>{B}</p></section><p>end</p></main>",
     f"Title\n{A}\n{B}\nend"),
    (f"<article><p>{A}</p><article><p>{B}</p><p>{A}</p></article><p>end</p></article>", f"{A}\n{B}\n{A}\nend"),
    (f'<main><article><p>{A}</p></article><ul><li><a href="/">Other story</a></ul></main>', A),
    (f'<body><article><p>{A}</p></article><section><p><a href="/">Other story</a></p></section></body>', A),
])
def test_siblings_of_an_article(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("more, text", [
    ("<ul><li>one</ul>", "one"), ("<ol><li>one</ol>", "one"), ("<table><tr><td>one</table>", "one"),
    ("<figure><figcaption>one</figcaption></figure>", "one"), ("<section><p>one</p></section>", "one"),
    ("<dl><dt>one<dd>two</dl>", "one\ntwo")])
def test_short_siblings_of_a_long_container(more, text):
    long = f"<div><p>{A}</p><p>{B}</p></div>"
    links = '<ul><li><a href="/">Home</a></ul><table><tr><td><a href="/">x</a></table>'
    page = f'<div class="page">{long}{more}{links}</div>'
    assert html_text.main_text(page.replace("</p><p>", f"</p>{'<p>' + A + '</p>'}<p>")) == f"{A}\n{A}\n{B}\n{text}"
