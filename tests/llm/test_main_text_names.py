"""Main text of pages whose parts have names as sites give them."""

import itertools

import pytest

from hearth.llm import html_text

A = "The first part of the story, told at length, with commas, and enough words to count as a paragraph of its own."
B = "The second part of the story, as long as the first, with commas too, and words enough to count as one as well."
OTHER = "Someone else wrote this, at some length, and with a comma or two, though it is no part of the story at all."
ARTICLE = f"<p>{A}</p><p>{B}</p>"


@pytest.mark.parametrize("part", [
    f'<div class="reader-comments"><p>{OTHER}</p></div>', f'<section id="user-comments"><p>{OTHER}</p></section>',
    f'<div class="article-comments"><p>{OTHER}</p></div>', f'<div class="google-ad"><p>{OTHER}</p></div>',
    f'<div class="dfp-ad"><p>{OTHER}</p></div>', f'<div class="js-cookie-notice"><p>{OTHER}</p></div>',
    f'<div class="blog-sidebar"><p>{OTHER}</p></div>', f'<div class="entry-share"><p>{OTHER}</p></div>',
    f'<div class="readerComments"><p>{OTHER}</p></div>', f'<div class="post__related-list"><p>{OTHER}</p></div>',
    f'<section><h3>12 Comments</h3><p>{OTHER}</p></section>',
    f'<section class="thread"><h2>Replies</h2><p>{OTHER}</p></section>',
    f'<div><div><h4>Leave a reply</h4></div><p>{OTHER}</p></div>',
    "<ul>" + f'<li><b>Ann</b><p>{OTHER}</p><a href="#">Reply</a></li>' * 3 + "</ul>",
    "<div>" + f"<div><p>{OTHER}</p><button>Reply</button></div>" * 2 + "</div>"])
@pytest.mark.parametrize("page", [
    "<body><article>{0}{1}</article></body>", "<body><main>{0}{1}</main></body>",
    "<body><article>{0}</article>{1}</body>", '<body><div class="post">{0}</div>{1}</body>',
    "<main><article>{0}</article>{1}</main>"])
def test_parts_that_are_not_the_article(part, page):
    assert html_text.main_text(page.format(ARTICLE, part)) == f"{A}\n{B}"


@pytest.mark.parametrize("part", ['<div id="feedback"><p>{}</p></div>', '<section class="discussion"><p>{}</p></section>',
                                  '<section class="thread"><p>{}</p></section>'])
@pytest.mark.parametrize("page", [
    "<main>{0}{1}</main>", "<body><article>{0}</article>{1}</body>", "<main><article>{0}</article>{1}</main>"])
def test_talk_outside_of_the_article(part, page):
    assert html_text.main_text(page.format(ARTICLE, part.format(OTHER))) == f"{A}\n{B}"


def test_a_paper_keeps_its_discussion():
    page = f'<article><p>{A}</p><section id="discussion"><h2>Discussion</h2><p>{B}</p></section></article>'
    assert html_text.main_text(page) == f"{A}\nDiscussion\n{B}"


@pytest.mark.parametrize("name", [
    "comments-open", "no-comments", "has-sidebar", "content-with-sidebar", "ad-free", "shared", "address", "download",
    "commentary", "notice-board-story", "elementor-widget", "threaded", "entry-content", "article-header-image",
    "single-post", "share-price-report", "menu-planning", "related-work-text"])
def test_names_that_say_something_else(name):
    assert html_text.main_text(f'<article><p>{A}</p><div class="{name}"><p>{B}</p></div></article>') == f"{A}\n{B}"


def test_link_cells_of_a_table_layout():
    page = (f'<table><tr><td><a href="/">Home</a><br><a href="/x">News</a></td><td>{A}</td></tr>'
            f'<tr><td><a href="/y">Other</a></td><td>{B}</td></tr></table>')
    assert html_text.main_text(page) == f"{A}\n{B}"


def test_link_cells_of_a_table_in_the_article_stay():
    page = f'<article>{ARTICLE}<table><tr><td><a href="/">Home</a></td><td>{A}</td></tr></table></article>'
    assert html_text.main_text(page) == f"{A}\n{B}\nHome\n{A}"


HEADS = ["", "<header><h1>Site</h1></header>", '<div class="site-header"><p>The Site, daily, since long ago.</p></div>',
         '<nav><ul><li><a href="/">Home</a></ul></nav>']
BODIES = ["<article>{}</article>", "<main>{}</main>", '<div class="post">{}</div>', '<div id="content"><div>{}</div></div>',
          "<main><div><article>{}</article></div></main>"]
SIDES = ["", f'<aside><p>{OTHER}</p></aside>', f'<div class="left-sidebar"><p>{OTHER}</p></div>',
         f'<div id="blog-sidebar"><ul><li>{OTHER}</ul></div>']
ENDS = ["", "<footer><p>Imprint, privacy, and so on.</p></footer>", f'<div class="post-footer"><p>{OTHER}</p></div>',
        f'<div id="comments" class="comments-area"><ol><li><p>{OTHER}</p></ol></div>']


@pytest.mark.parametrize("head, body, side, end", list(itertools.product(HEADS, BODIES, SIDES, ENDS)))
def test_whole_pages_of_varied_layouts(head, body, side, end):
    story = (f"<p>{A}</p><h2>A heading</h2><p>{B}</p><blockquote>As one said: so be it, now and then.</blockquote>"
             '<script>var x = 1;</script><div class="ad"><p>Buy, now.</p></div><ul><li>first item<li>second item</ul>')
    text = f"{A}\nA heading\n{B}\nAs one said: so be it, now and then.\nfirst item\nsecond item"
    page = (f"<!doctype html><html><head><title>Story</title><style>p {{ x: y }}</style></head><body>{head}"
            f'{side}{body.format(story)}<form><input><p>Write to us.</p></form>{end}</body></html>')
    assert html_text.main_text(page) == text


def test_deep_pages_are_linear():
    assert html_text.main_text("<div>" * 30_000 + f"<p>{A}</p>") == A
    assert html_text.main_text("<div><a>" * 5_000 + A) is not None
