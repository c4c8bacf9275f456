"""Short blocks outside <article> and <main>: kept beside text, left out among links."""

from __future__ import annotations

import pytest

from stayledger.llm import html_blocks

LONG = "many words of running text that go on " * 10


@pytest.fixture(scope="module")
def tree():
    return html_blocks.train()


@pytest.mark.parametrize(("page", "expected"), [
    (f"<div class=content><h1>Three word title</h1><p>{LONG}</p></div>", ["Three word title", LONG.strip()]),
    (f"<div role=main><p>{LONG}</p><h2>Part</h2><p>Short.</p><p>{LONG}</p></div>", [LONG.strip(), "Part", "Short.", LONG.strip()]),
    (f"<body><p>{LONG}</p><ul><li>First item<li>Second<li>Third one</ul>", [LONG.strip(), "First item", "Second", "Third one"]),
    ("<body><table><tr><th>Name<th>Size<tr><td>a<td>1<tr><td>b<td>2</table>", ["Name", "Size", "a", "1", "b", "2"]),
    (f"<nav><a>Home</a></nav><h1>Title</h1><p>{LONG}</p><p>Done.</p><footer><a>About</a></footer>", ["Title", LONG.strip(), "Done."]),
    ("<body>Hello world", ["Hello world"]),
    ("<ul><li><a>One</a><li>or<li><a>Two</a></ul><p><a>Three</a></p>", []),
])
def test_short_blocks(tree, page, expected):
    assert html_blocks.main_text(page, tree).split("\n") == (expected or [""])


def test_neighbours_decide_on_short_blocks_only(tree):
    for n in (1, 3, 5, 8, 9, 30, 300):
        for before in ([1, 0.0], [6, 0.1], [80, 0.0], [1, 1.0], [9, 0.8], [40, 0.7]):
            for after in ([1, 0.0], [6, 0.1], [80, 0.0], [1, 1.0], [9, 0.8], [40, 0.7]):
                among_links = before[1] > 0.5 and after[1] > 0.5
                text = html_blocks.decide(tree, [n, 0.0, *before, *after, 0.0, 0.0]) >= 0.5
                assert text == (n > 8 or not among_links), (n, before, after)
                for links in (0.7, 1.0):
                    assert html_blocks.decide(tree, [n, links, *before, *after, 0.0, 0.0]) < 0.5, (n, links, before, after)
