"""Main texts of pages whose marks or paths mislead."""

import pytest

from roleatlas.llm import html_extract

BODY = [f"Paragraph {k}, of the article, says a good deal; it goes on, and on." for k in range(4)]
TEXT = "".join(f"<p>{p}</p>" for p in BODY)


@pytest.mark.parametrize("name", [
    "page has-sidebar", "page no-sidebar", "header", "search", "share", "social", "related-layout", "notice", "overlay",
])
@pytest.mark.parametrize("inner", ["<article>%s</article>", "<main>%s</main>", "<div>%s</div>"])
def test_marked_wrapper_keeps_its_article(name, inner):
    page = f'<html><body><div class="{name}">{inner % TEXT}</div><div>Imprint</div></body></html>'
    assert html_extract.main_text(page).split("\n") == BODY


def test_marks_are_judged_by_their_text():
    page = (
        '<html><body><article><div class="article-header"><h1>Title</h1></div><div class="share"><p>Tweet</p></div>'
        f'<div data-id="share" data-role="ad" title="x class=ad">{TEXT}</div><div class="ad">Buy</div></article></body></html>'
    )
    assert html_extract.main_text(page).split("\n") == ["Title", *BODY]


def test_all_content_paths_stay():
    second = "".join(f"<p>{p}</p>" for p in BODY[2:])
    page = (
        f'<html><body><div>Menu</div><div><p>{BODY[0]}</p><p>{BODY[1]}</p></div><h2>Next</h2>'
        f'<div><section>{second}<ul><li>short</ul></section></div><div>Imprint</div></body></html>'
    )
    assert html_extract.main_text(page).split("\n") == [*BODY[:2], "Next", *BODY[2:], "short"]


def test_all_articles_with_content_stay():
    page = (
        f"<html><body><article><p>{BODY[0]}</p><p>{BODY[1]}</p></article>"
        f"<article><section><p>{BODY[2]}</p></section></article><p>Imprint</p></body></html>"
    )
    assert html_extract.main_text(page).split("\n") == BODY[:3]
