from cadenza.llm import html_extract

P = "<p>A first paragraph, long enough to be counted, with commas.</p><p>And a second one, of the same kind, here.</p>"
TEXT = "A first paragraph, long enough to be counted, with commas.\n\nAnd a second one, of the same kind, here."


def test_names_do_not_remove_the_article():
    for names in ('class="content has-sidebar"', 'id="main-with-nav"', 'class="content sidebar-right"', 'class="widget"'):
        assert html_extract.main_text(f"<body><div {names}>{P}</div></body>") == TEXT
    page = f'<body><div class="content has-sidebar">{P}<div class="sidebar"><p>Side, text, of the bar.</p></div></div></body>'
    assert html_extract.main_text(page) == TEXT


def test_headline_in_the_header_of_an_article():
    page = f'<body><header class="site-header"><h1>Site</h1></header><article><header class="entry-header"><h1>Head</h1></header>{P}<div class="post-comments"><p>I liked it, very much.</p></div></article></body>'
    assert html_extract.main_text(page) == "Head\n\n" + TEXT


def test_forms_names_and_depth():
    import time

    assert html_extract.main_text(f'<body><form id="aspnetForm"><input name="q"><div class="content">{P}</div></form></body>') == TEXT
    assert html_extract.main_text(f"<body><article>{P}<form><p>Your name, please.</p></form></article></body>") == TEXT
    for names in ("post with-ad", "lead header-article", "roadmap"):
        assert html_extract.main_text(f'<body><article class="{names}">{P}</article></body>') == TEXT
    assert html_extract.main_text(f'<body><div id="header-image">{P}</div></body>') == TEXT
    spent = []
    for n in (2000, 8000):
        at = time.process_time()
        assert html_extract.main_text("<div>x<a>y</a>" * n)
        html_extract.main_text("<div><span>" * n + "</section>" * n + P)
        spent.append(time.process_time() - at)
    assert spent[1] < 12 * spent[0]  # four times the page
