"""Labelled pages from which the weights of html_content are fitted.

``data-label="content"`` marks main text and ``data-label="other"`` everything
else; the innermost mark around a word is its label, unmarked words are other.
"""

PAGES = [
    """<body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">Contact us</a></li></ul></nav>
    <div class="ad">Buy now and save a lot of money today</div>
    <article data-label="content"><h1>The harbour opens again</h1><p>After two years of work the <b>old harbour</b> takes ships again.<br>
    <p>Crowds came to <a href="/x">watch the first ferry</a> and stayed until dark.</p></article>
    <footer>&copy; example.org &middot; all rights reserved</footer></body>""",
    """<body><header><div class="logo">The Daily</div><ul class="menu"><li><a href="/s">Sport</a></li><li><a href="/w">Weather</a></li></ul></header>
    <div class="cookie-notice">We use cookies to improve your visit <button>Accept all</button></div>
    <main><article data-label="content"><header><h1>Rain at last</h1><p>By our reporter</p></header>
    <p>The first rain in months fell on the hills above the town.</p><blockquote>We danced in the street, said one farmer.</blockquote>
    <ul><li>Forty litres fell on the square metre</li><li>The reservoir rose by a hand</li></ul>
    <div class="advert" data-label="other">Sponsored: cheap umbrellas for everyone</div>
    <p>More rain is expected before the weekend.</p><figure><figcaption>The swollen river</figcaption></figure></article>
    <section class="comments"><h2>Comments</h2><div class="comment"><p>I never believed the forecast anyway.</p></div><div class="comment"><p>Finally something good happened here.</p></div></section></main>
    <aside class="sidebar"><h3>Most read</h3><ol><li><a href="/1">Ten ways to cook rice</a></li><li><a href="/2">The lost dog of the mill</a></li></ol></aside>
    <footer class="site-footer"><p>Imprint and privacy</p></footer></body>""",
    """<body><div id="header"><p>Free delivery over fifty</p></div><div id="nav" role="navigation"><a href="/h">Start</a> <a href="/p">Products</a></div>
    <div id="content"><div class="post" data-label="content"><h2>How to sharpen a chisel</h2><p>Begin with a coarse stone and keep the angle.</p>
    <p>Then move to a finer stone until a burr can be felt along the edge.</p><table><tr><td>Coarse stone grit</td><td>Fine stone grit</td></tr></table><pre>angle = 25</pre></div>
    <form action="/subscribe"><label>Your address for our letter</label><input name="m"><button>Subscribe</button></form>
    <div class="share social"><a href="/f">Share this</a></div><div class="related"><h4>Related posts</h4><ul><li><a href="/r">Planes for beginners</a></li></ul></div>
    <div id="comments"><p>Thank you, this helped me a lot.</p></div></div><div id="sidebar"><p>About the author of this page</p></div>
    <div id="footer"><p>Made with care, all rights reserved</p></div></body>""",
    """<body><div class="banner promo"><p>Summer sale ends tonight</p></div><div class="breadcrumb"><a href="/">Home</a> <a href="/g">Guides</a></div>
    <section data-label="content"><h1>Walking the ridge</h1><p>The path starts behind the church and climbs through larch woods.</p><div><p>Carry water, there is none above the hut.</p></div>
    <dl><dt>Length of the walk</dt><dd>Nine kilometres in all</dd></dl></section>
    <div class="newsletter popup modal"><p>Sign up and never miss a walk</p></div><div class="warning alert notice"><p>Your browser is out of date</p></div>
    <aside><p>Hut keepers wanted for the summer</p></aside><div class="pagination pager"><a href="/2">Next page</a></div>
    <div class="copyright legal">Copyright by the walking club</div></body>""",
    """<body><div class="ads sponsor sponsored"><p>Win a holiday for two</p></div><div role="banner"><p>Community radio</p></div><div class="toolbar login search"><a href="/l">Log in</a></div>
    <div role="main" data-label="content"><h1>A night at the station</h1><p>Nobody sleeps when the transmitter hums.</p><p>At four the bread comes, still warm.</p><h3>The morning shift</h3><p>Voices change, the hum does not.</p></div>
    <div role="complementary"><p>Listen live on the air</p></div><div class="reply discussion responses disqus"><article><p>Greetings from the north, great show!</p></article></div>
    <div class="widget tags meta"><a href="/t">radio</a> <a href="/u">night</a></div><div role="contentinfo"><p>Studio line and post address</p></div>
    <div class="consent gdpr cookies cookie"><p>We value your privacy and our partners do too</p></div><div hidden><p>Loading, please wait</p></div></body>""",
    """<body><p data-label="content">A plain page has only its words and nothing around them at all.</p><p data-label="content">It is still a page, and its words are its content.</p>
    <div data-label="content"><p>Even a box without a name holds text that people came to read.</p><span>And so does a span.</span></div></body>""",
    """<body><div><div><div><div data-label="content"><div>Some pages are boxes inside boxes inside boxes.</div><div>Their words still are the story that was written.</div>
    <div><div>However deep they lie, they count.</div><div><span>Even when only a span holds them together.</span></div></div></div></div></div></div>
    <div><div><ul><li><a href="/1">Terms</a></li><li><a href="/2">Press</a></li></ul></div></div></body>""",
    """<html><body><div><main><article data-label="content"><div><div>The column begins without a paragraph.</div></div><p>Later it has one, and then another.</p>
    <nav data-label="other"><p>On this page you find three parts</p><ol><li><a href="#1">First part</a></li></ol></nav><aside data-label="other"><p>Our reader survey is open</p></aside>
    <p>The story goes on after the box.</p><form data-label="other"><p>Vote for the best story of the month</p><label>Your name</label></form>
    <div class="share related" data-label="other"><p>Share this story with your friends</p></div><div class="widget banner" data-label="other"><p>Sponsored stories for you</p></div>
    <div class="menu" data-label="other"><p>Jump to the part you want</p></div><div class="login newsletter subscribe" data-label="other"><p>Log in to read without adverts</p></div>
    <div class="notice" data-label="other"><p>This story was moved from the old site</p></div><div class="copyright" data-label="other"><p>Not to be copied</p></div>
    <p>And it ends here, as all stories do.</p><footer data-label="other"><p>Filed under stories</p></footer>
    <section class="comments" data-label="other"><h3>Reader comments</h3><p>What a story that was!</p><blockquote>As all stories do.</blockquote></section></article></main></div></body></html>""",
    """<body><div class="wrapper container page"><div class="header"><p>The weekly sheet</p></div><div><div data-label="content"><h1>Bread without haste</h1><p>Mix the flour with water at night.</p><p>In the morning it has risen.</p>
    <h2>The oven</h2><p>It should be as hot as it will go.</p><div>Steam makes the crust shine.</div><ul><li>Flour and water</li><li>Salt and <a href="/y">yeast</a></li></ul><div><p>Wait until it is cold.</p></div></div></div>
    <div class="ad"><p>Flour at half price</p></div><div class="footer"><p>Printed on paper</p></div></div></body>""",
    """<body><div data-label="content"><p>A box, a line.</p><p>Another line in it.</p><div><h3>And a head</h3><p>With its own line.</p></div></div><div class="cookie"><p>Cookies here</p></div><div class="promo"><p>Only this week</p></div>
    <div class="subscribe"><p>Get our letter</p></div><div class="related"><p>You may like</p></div><div class="comment"><p>I like it</p></div><div class="pagination"><p>Next</p></div><div class="breadcrumb"><p>Up</p></div></body>""",
    """<div><div data-label="content"><p>A fragment has no body around it.</p><p>It still can be read.</p><div>Its boxes too.</div></div></div><div class="advertisement ads"><p>Not this</p></div>""",
    """<div data-label="content"><p>One more of its kind.</p><p>Short, but whole.</p></div><div class="advertising"><p>Nor this</p></div><div id="main-content" data-label="content"><p>Named as content.</p></div>""",
    """<div data-label="content">Only a box.</div><div data-label="content"><div>And one inside.</div></div><div class="comments"><p>Nor what others say</p></div>""",
]

#: Names of classes and roles whose elements stand inside articles without being part of them (fixed values).
OTHER = """ad ads advert advertisement advertising sponsor sponsored promo banner cookie consent gdpr notice warning alert popup modal newsletter subscribe subscription
share social related recommended comment comments reply replies discussion responses disqus sidebar widget menu nav navigation navbar breadcrumb breadcrumbs pagination pager
login signup search toolbar footer header copyright legal hidden complementary contentinfo teaser tags""".split()

PAGES += [
    f"""<article data-label="content"><p>Before the box there is text.</p><div class="{x}" data-label="other"><p>What stands in the box</p><span>is something else</span></div><p>After it the text goes on.</p></article>
    <div class="{x}"><p>Outside it is no better</p><article class="{x}"><p>Nor in an article of its own</p></article></div><div data-label="content"><p>Without a name it is text.</p></div>"""
    for x in OTHER
]
PAGES += [
    f"""<main data-label="content"><p>Before the part there is text.</p><{x} data-label="other"><p>What stands in it</p></{x}><p>After it the text goes on.</p></main><{x}><p>Outside it is no better</p></{x}>"""
    for x in ("nav", "aside", "footer", "form", "button", "dialog")
]
PAGES += [
    f"""<body><{x}>Bare words before it</{x.split()[0]}><article data-label="content"><h1>A head</h1><p>A line of text.</p></article><{x}>Bare words after it</{x.split()[0]}></body>"""
    for x in ("nav", "aside", "footer", "header", "form", "dialog", *(f'div class="{x}"' for x in OTHER))
]
