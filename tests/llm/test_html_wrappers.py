"""Marked wrappers around the article don't lose it; marked parts beside it stay out."""

from __future__ import annotations

import pytest

from geoloom.llm import html

TEXT = [f"This is sentence number {i} of the article, and it is long enough to count as content." for i in range(8)]
BODY = "".join(f"<p>{x}</p>" for x in TEXT)
SIDE = '<div class="sidebar"><p>Short notes of the side stand here.</p><a href=a>One</a></div><div id="comments"><p>I like this very much, thank you.</p></div>'


@pytest.mark.parametrize("wrapper", ['<main class="content with-sidebar">{}</main>', '<div id="no-sidebar">{}</div>', '<div class="has-nav">{}</div>', '<form action="x" method="post">{}</form>', '<form><div class="has-nav"><article>{}</article></div></form>', '<div class="with-sidebar"><div class="no-comments">{}</div></div>'])
def test_wrappers(wrapper):
    out = html.main_text(f"<html><body><nav><a href=a>Home</a></nav>{wrapper.format(BODY + SIDE)}<footer>All rights reserved.</footer></body></html>")
    assert out.split("\n") == TEXT


def test_long_comments_stay_out():
    page = f'<body><div class="text">{BODY}</div><div id="comments">{"".join(f"<p>My own view of it is number {i}, for what that is worth to you all.</p>" for i in range(14))}</div></body>'
    assert html.main_text(page).split("\n") == TEXT


def test_hidden_stays_hidden():
    assert html.main_text(f'<div style="display:none"><main>{BODY}</main></div>') == ""
