"""Hand-written pages in common layouts, and their main texts."""

P = [f"Paragraph {i} tells how the river changed its course in the year {1800 + i}." for i in range(6)]
BODY = "".join(f"<p>{p}</p>" for p in P)
TEXT = "\n".join(P)
TITLE = "The river and the town"

LAYOUTS = {
    "blog theme, class words on body": (
        f"""<html class="js no-touch"><body class="post-template single single-post has-sidebar sidebar-right header-fixed footer-dark cookie-accepted no-comments widget-ready">
        <header id="masthead" class="site-header"><p>My blog</p><nav><a href="/">Home</a><a href="/about">About</a></nav></header>
        <div id="page" class="site"><main id="main" class="site-main with-sidebar"><article id="post-12" class="post-12 post type-post has-post-thumbnail hentry category-ads tag-header tag-cookie">
        <header class="entry-header"><h1 class="entry-title">{TITLE}</h1></header><div class="entry-content">{BODY}</div></article>
        <div id="comments" class="comments-area"><h2>Two thoughts</h2><ol class="comment-list"><li class="comment"><article class="comment-body"><p>I liked the third one most of all.</p></article></li></ol></div></main>
        <aside id="secondary" class="widget-area"><h3>Recent posts</h3><ul><li><a href="/1">The mill</a></li></ul></aside></div>
        <footer class="site-footer">Powered by rivers</footer></body></html>""",
        f"{TITLE}\n{TEXT}",
    ),
    "same words on article": (
        f"""<body><article class="no-sidebar header-fixed cookie-accepted footer-dark sidebar-left"><h1>{TITLE}</h1>{BODY}</article><footer>All rights reserved</footer></body>""",
        f"{TITLE}\n{TEXT}",
    ),
    "frame div that holds the page": (
        f"""<body class="no-sidebar header-fixed"><div class="layout-sidebar header-top"><div class="menu"><a href="/">Start</a> <a href="/b">Boats</a></div><div class="inner"><h1>{TITLE}</h1>{BODY}</div></div>
        <div class="footer">Made by hand</div></body>""",
        f"{TITLE}\n{TEXT}",
    ),
    "text in bare divs under a named body": (
        f"""<body class="sidebar header"><div><div><h1>{TITLE}</h1>{''.join(f'<div>{p}</div>' for p in P)}</div></div><div class="copyright">Nobody</div></body>""",
        f"{TITLE}\n{TEXT}",
    ),
    "second-level title, no sections": (
        f"""<body><div class="topbar menu"><a href="/">Home</a></div><div class="post"><h2>{TITLE}</h2>{BODY}</div><div class="related-posts"><h3>More</h3><a href="/x">Old mills</a></div></body>""",
        f"{TITLE}\n{TEXT}",
    ),
    "tables for layout": (
        f"""<body bgcolor="#ffffff"><table width="100%"><tr><td class="nav" width="20%"><a href="/1">Home</a><br><a href="/2">Maps</a></td><td><h1>{TITLE}</h1>{BODY}</td></tr></table>
        <center class="copyright"><font size="1">Copyright 1998</font></center></body>""",
        f"{TITLE}\n{TEXT}",
    ),
    "paragraphs only": (f"<h1>{TITLE}</h1>{BODY}", f"{TITLE}\n{TEXT}"),
    "news with adverts inside": (
        f"""<body><div id="cookie-banner" class="cookie-notice"><p>We use cookies.</p><button>Fine</button></div><div id="wrapper"><div class="breadcrumb"><a href="/">News</a></div>
        <article><h1>{TITLE}</h1><p>{P[0]}</p><div class="ad-slot"><p>Buy a boat</p></div><p>{P[1]}</p><aside class="related"><p>Read also about dams</p></aside><p>{P[2]}</p><div class="newsletter-signup"><form><label>Mail</label></form></div>
        <p>{P[3]}</p><p>{P[4]}</p><p>{P[5]}</p></article></div></body>""",
        f"{TITLE}\n{TEXT}",
    ),
    "documentation with a menu and code": (
        f"""<body class="docs theme-dark"><nav class="navbar"><a href="/docs">Docs</a></nav><div class="container"><div class="sidebar"><ul><li><a href="/a">Install</a></li><li><a href="/b">Use</a></li></ul></div>
        <main class="docs-content"><h1>{TITLE}</h1>{BODY}<pre><code>x = river()</code></pre><ul><li>first part</li><li>second part</li></ul><div class="pagination"><a href="/n">Next page</a></div></main></div></body>""",
        f"{TITLE}\n{TEXT}\nx = river()\nfirst part\nsecond part",
    ),
    "page builder": (
        f"""<body class="elementor-default elementor-page header-sticky"><div class="elementor-location-header header"><p>Call us today</p></div><div class="elementor"><section class="elementor-section"><div class="elementor-column"><h1 class="heading-title header">{TITLE}</h1></div></section>
        <section><div><div class="text-editor">{BODY}</div></div></section></div><div class="elementor-location-footer footer"><p>Open from nine to five</p></div></body>""",
        f"{TITLE}\n{TEXT}",
    ),
    "short article, long talk": (
        f"""<body><main><article><h1>{TITLE}</h1><p>{P[0]}</p></article><section id="comments" class="comments">{''.join(f'<div class="comment"><p>Reader {i} says that this is all wrong and should be told anew.</p></div>' for i in range(12))}</section></main></body>""",
        f"{TITLE}\n{P[0]}",
    ),
    "upper case, unclosed paragraphs": (
        f"""<HTML><BODY CLASS="HOME"><DIV CLASS="Header">Old site</DIV><DIV ID="Content"><H1>{TITLE}</H1>{''.join(f'<P>{p}' for p in P)}</DIV><DIV CLASS="Footer">Best viewed at night</DIV></BODY></HTML>""",
        f"{TITLE}\n{TEXT}",
    ),
    "nothing but boilerplate": ("""<body><nav><a href="/">Home</a></nav><div class="ad">Buy a boat</div><footer>All rights reserved</footer></body>""", ""),
}

#: Pages whose frames, sections and boxes are not those of the ones above.
COMMENTS = "<p>I read this on the train.</p><p>So did I, twice.</p>"
MORE_LAYOUTS = {
    "article inside one form": (f"""<html><body><form id="aspnetForm" action="/x"><div class="topbar"><a href="/">Start</a></div><article><h1>{TITLE}</h1>{BODY}</article><div class="footer">Made here</div></form></body></html>""", f"{TITLE}\n{TEXT}"),
    "div with a heading inside a form": (f"""<html><body><form method="post"><div class="content"><h1>{TITLE}</h1>{BODY}</div></form></body></html>""", f"{TITLE}\n{TEXT}"),
    "div without a heading inside a form": (f"""<html><body><form method="post"><div>{BODY}</div><div id="footer"><p>Imprint</p></div></form></body></html>""", TEXT),
    "main inside a form, second form inside": (f"""<html><body><form><main><h1>{TITLE}</h1>{BODY}<div class="newsletter"><form><p>Get our letter</p><input></form></div></main></form></body></html>""", f"{TITLE}\n{TEXT}"),
    "comments in a section": (f"""<html><head><title>x</title></head><body><article><h1>{TITLE}</h1>{BODY}</article><section class="comments">{COMMENTS}</section></body></html>""", f"{TITLE}\n{TEXT}"),
    "headed comments, footer and aside": (
        f"""<html><body><article><h1>{TITLE}</h1>{BODY}</article><section class="comments"><h3>What readers say</h3>{COMMENTS}</section><aside><h3>Most read</h3><p>The mill that burned</p></aside>
        <footer><h3>About this paper</h3><p>Printed since the war.</p></footer></body></html>""",
        f"{TITLE}\n{TEXT}",
    ),
    "the same without html": (
        f"""<article><h1>{TITLE}</h1>{BODY}</article><section class="comments"><h3>What readers say</h3>{COMMENTS}</section><aside><h3>Most read</h3><p>The mill that burned</p></aside><footer><h3>About this paper</h3></footer>""",
        f"{TITLE}\n{TEXT}",
    ),
    "notices in sections": (
        f"""<html><body><article><h1>{TITLE}</h1>{BODY}</article><section class="cookie"><p>We store things on your disk.</p></section><section class="newsletter"><p>Read us every Friday.</p></section>
        <section class="related"><h2>More of it</h2><p>How the dam was built</p></section></body></html>""",
        f"{TITLE}\n{TEXT}",
    ),
    "comment list named in one word": (f"""<html><body><div class="post"><h1>{TITLE}</h1>{BODY}</div><ol class="commentlist"><li><p>First!</p></li><li><div>That river is a stream.</div></li></ol></body></html>""", f"{TITLE}\n{TEXT}"),
    "header block around everything": (f"""<html><body><h1>{TITLE}</h1><div class="section header-block">{BODY}</div><footer>All rights reserved</footer></body></html>""", f"{TITLE}\n{TEXT}"),
    "promo text around half": (f"""<html><body><main><h1>{TITLE}</h1>{''.join(f'<p>{p}</p>' for p in P[:3])}<div class="promo-text">{''.join(f'<p>{p}</p>' for p in P[3:])}</div></main></body></html>""", f"{TITLE}\n{TEXT}"),
    "header block around half": (f"""<html><body><main><div class="header-block"><h1>{TITLE}</h1>{''.join(f'<p>{p}</p>' for p in P[:3])}</div>{''.join(f'<p>{p}</p>' for p in P[3:])}</main></body></html>""", f"{TITLE}\n{TEXT}"),
    "sections of divs": (
        f"""<html><body><section class="hero"><h1>{TITLE}</h1></section><section>{''.join(f'<div>{p}</div>' for p in P[:3])}</section><section>{''.join(f'<div>{p}</div>' for p in P[3:])}</section>
        <section class="site-footer"><div>Call us on Mondays</div></section></body></html>""",
        f"{TITLE}\n{TEXT}",
    ),
    "comments with articles and quotes": (
        f"""<html><body><div id="wrap"><div id="content"><h2>{TITLE}</h2>{BODY}</div><div id="disqus_thread"><article><blockquote><p>The town again.</p></blockquote><p>Always the town.</p></article></div></div></body></html>""",
        f"{TITLE}\n{TEXT}",
    ),
    "aside and form inside a bare div": (f"""<html><body><div>{''.join(f'<p>{p}</p>' for p in P[:3])}<aside><h4>In short</h4><p>Rivers move.</p></aside><form><h4>Vote</h4><p>Which river?</p></form>{''.join(f'<p>{p}</p>' for p in P[3:])}</div></body></html>""", TEXT),
    "dialog and cookie bar first": (f"""<html><body><dialog open><h2>Welcome</h2><p>Please choose a region.</p></dialog><div class="cookiebar"><p>Crumbs everywhere.</p></div><div><div><h1>{TITLE}</h1>{BODY}</div></div></body></html>""", f"{TITLE}\n{TEXT}"),
}
LAYOUTS |= MORE_LAYOUTS
