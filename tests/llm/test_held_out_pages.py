"""Precision and recall of the main text on pages written by hand, apart from the generator of the tree's labelled table.

Every page imitates a layout in use (a theme, a table layout of the nineties, documentation, a news site without an
article tag, ...). A block that belongs to the main text begins with a star.
"""

import re
from collections import Counter

from placemark.llm import html_text

P1 = "The ferry left the harbour before sunrise, and most of the crew were still asleep when the fog came down over the narrow channel between the islands."
P2 = "Nobody had expected the weather to turn so early in the season; the forecast of the evening before had promised clear skies until Thursday at least."
P3 = "By noon the engineers had found the fault, a cracked valve no larger than a coin, and the captain decided to turn back rather than risk the crossing."
P4 = "Repairs took two days. Meanwhile the passengers were housed in the old school, where the villagers brought soup, bread and more blankets than anyone needed."
SHORT = "It was worth the wait."
NOTE = "We and our partners store information on a device to personalise content. You can change your choices at any time in the settings of this site."
BIO = "Great write-up, I took the same boat in 1998 and the crew told us a very similar story about the fog and the school in the village."

HELD_OUT = {
    "theme": f"""<!doctype html><html><head><title>Fog</title><style>p{{x:y}}</style></head><body class="home blog"><div id="page"><header id="masthead" class="site-header"><h1 class="site-title"><a href="/">Island Post</a></h1>
<nav id="site-navigation"><ul id="primary-menu"><li><a href="/a">News</a></li><li><a href="/b">Weather</a></li></ul></nav></header><div id="content" class="site-content"><div id="primary"><main id="main">
<article id="post-7" class="post-7 post type-post hentry"><header class="entry-header"><h1 class="entry-title">*Two days in the fog</h1></header><div class="entry-content"><p>*{P1}</p><p>*{P2}</p><h2>*The valve</h2><p>*{P3}</p></div></article>
<div id="comments" class="comments-area"><h2>One thought</h2><ol class="comment-list"><li><p>{BIO}</p></li></ol><div id="respond"><form><p>Leave a reply</p></form></div></div></main></div>
<aside id="secondary" class="widget-area"><section class="widget"><h2>Recent posts</h2><ul><li><a href="/1">Another story</a></li></ul></section></aside></div><footer id="colophon"><div>Proudly made on the island</div></footer></div></body></html>""",
    "tables of the nineties": f"""<html><body bgcolor=white><table width=760><tr><td colspan=2><img src=logo.gif><font size=1><a href=index.htm>Home</a> | <a href=news.htm>News</a> | <a href=map.htm>Map</a></font></td></tr><tr><td width=150 valign=top>
<a href=1.htm>Archive</a><br><a href=2.htm>Photographs</a><br><a href=3.htm>Guest book</a></td><td><font size=5><b>*Two days in the fog</b></font><p>*{P1}<p>*{P2}<p>*{P3}<p>*{P4}</td></tr></table><center><font size=1>Copyright 1999 Island Post. <a href=mailto:x>Write to us</a></font></center></body></html>""",
    "divs alone": f"""<body><div class="topbar"><a href="/">Start</a> <a href="/login">Sign in</a></div><div class="container"><div class="row"><div class="col-md-8"><div class="story"><div class="headline"><h1>*Ferry turns back</h1></div>
<div class="story-body"><div class="para">*{P1}</div><div class="para">*{P2}</div><div class="ad-slot"><p>Advertisement: fly to the islands for less</p></div><div class="para">*{P3}</div></div></div></div>
<div class="col-md-4 sidebar"><div class="box"><h4>Most read</h4><ol><li><a href="/x">Storm names of the year</a></li><li><a href="/y">Harbour to be closed</a></li></ol></div></div></div></div><div class="footer"><p>All rights reserved.</p></div></body>""",
    "documentation": f"""<body><nav class="md-header"><a href="/">Docs</a></nav><div class="md-container"><nav class="md-nav md-nav--primary"><ul><li><a href="/i">Install</a></li><li><a href="/u">Usage</a></li><li><a href="/r">Reference</a></li></ul></nav>
<main class="md-main"><div class="md-content"><article class="md-content__inner md-typeset"><h1>*Usage</h1><p>*Start the service with a folder of its own:</p><pre><code>*serve --root /srv/data --port 8080</code></pre><p>*{P2}</p><ul><li>*The folder must exist.</li><li>*The port must be free.</li></ul>
<table><thead><tr><th>*Option</th><th>*Meaning</th></tr></thead><tbody><tr><td>*root</td><td>*the folder that is served</td></tr></tbody></table></article></div></main></div><footer class="md-footer"><a href="/next">Next: Reference</a></footer></body>""",
    "consent and newsletter": f"""<body><div id="cookie-consent" role="dialog"><h2>Your privacy</h2><p>{NOTE}</p><button>Accept all</button></div><header><a href="/">The Tide</a></header><main><article><h1>*Soup, bread, blankets</h1><p>*{P4}</p><p>*{SHORT}</p>
<div class="newsletter-signup"><h3>Never miss a story</h3><p>Get our best reporting in your inbox every Sunday morning, for free.</p><form><input name=mail><button>Subscribe</button></form></div><p>*{P3}</p><blockquote>*We would do it again tomorrow.</blockquote><p>*{P1}</p></article>
<section class="related"><h2>Related</h2><ul><li><a href="/q">When the bridge was closed</a></li></ul></section></main><footer><p>The Tide is published by its readers.</p></footer></body>""",
    "sections without names": f"""<body><div><a href="/">Pen</a><a href="/in">Sign in</a></div><section><h1>*What the fog taught me</h1><p>*{P1}</p><figure><img src=f.jpg><figcaption>*The harbour on the second morning.</figcaption></figure><p>*{P2}</p><p>*{P3}</p><hr><p>*{P4}</p></section>
<footer><a href="/about">About</a><a href="/help">Help</a><a href="/terms">Terms</a></footer></body>""",
    "recipe": f"""<body><ul class="menu"><li><a href="/s">Soups</a></li><li><a href="/b">Breads</a></li></ul><article class="recipe"><h1>*Village soup</h1><p>*{P4}</p><h2>*Ingredients</h2><ul><li>*2 onions</li><li>*1 kg potatoes</li><li>*salt</li></ul><h2>*Method</h2><ol><li>*Slice the onions and fry them slowly in butter until they are soft.</li><li>*Add the potatoes and water, and cook for forty minutes.</li></ol></article>
<div class="social-share"><a href="#">Share</a> <a href="#">Pin</a></div><div id="disqus_thread"><p>{BIO}</p></div></body>""",
    "question page": f"""<body><header class="top"><form role="search"><input></form></header><div id="mainbar"><h1>*Why does fog form over cold water?</h1><div class="question"><p>*{P2}</p><p>*I would like to know why it came so quickly, and why it stayed for two whole days.</p></div></div>
<div id="sidebar"><div class="module"><h4>Hot questions</h4><ul><li><a href="/1">How do tides work</a></li><li><a href="/2">Why is the sea salt</a></li></ul></div></div><div id="footer"><p>Site design, logo, rights reserved</p></div></body>""",
    "notice of an authority": f"""<body><a href="#c">Skip to content</a><div class="banner" role="banner"><p>Harbour Authority</p></div><ol class="breadcrumb"><li><a href="/">Home</a></li><li><a href="/n">Notices</a></li></ol><main id="c"><h1>*Closure of the northern channel</h1><p>*{P3}</p><dl><dt>*From</dt><dd>*1 March, 06:00</dd><dt>*Until</dt><dd>*3 March, 18:00</dd></dl><p>*{P2}</p></main>
<footer role="contentinfo"><p>Content is available under an open licence, except where otherwise stated.</p><ul><li><a href="/p">Privacy</a></li></ul></footer></body>""",
    "page cut off": f"""<body><nav><a href="/">Home</a><a href="/more">More</a></nav><article><h1>*Cut short</h1><p>*{P1}</p><p>*{P2}</p><script>var x = "<p>not text</p>";</script><p>*{P3}</p><aside><p>Also on this site: ten pictures of fog you will not believe</p></aside><p>*{P4} <a hr""",
    "other scripts": """<body><div class="nav"><a href="/">Главная</a> <a href="/n">Новости</a></div><div class="article"><h1>*Паром вернулся в гавань</h1><p>*Паром вышел из гавани до рассвета, и большая часть команды ещё спала, когда над узким проливом между островами опустился густой туман.</p>
<p>*К полудню механики нашли поломку, треснувший клапан размером с монету, и капитан решил повернуть назад, а не рисковать переправой.</p></div><div class="footer">Все права защищены</div></body>""",
}


def test_held_out_pages(spark):
    rows = spark.createDataFrame([(i, name, page) for i, (name, page) in enumerate(HELD_OUT.items())], "page_id long, url string, html string")
    got = {r.url: [b for b in r.text.split("\n\n") if b] for r in html_text.extract(rows).collect()}
    found, wrong, missed = 0, {}, {}
    for name, page in HELD_OUT.items():
        want = Counter(b["text"] for b in html_text.blocks(page) if b["text"].startswith("*"))
        # The blocks are the stars of the page, less what it is cut off with.
        assert sum(want.values()) == len(re.findall(r">\s*\*", page))
        have = Counter(got[name])
        words = lambda c: sum(len(t.split()) * n for t, n in c.items())
        found += words(want & have)
        wrong[name], missed[name] = have - want, want - have
    extra, lost = (sum(len(t.split()) * n for c in x.values() for t, n in c.items()) for x in (wrong, missed))
    precision, recall = found / (found + extra), found / (found + lost)
    print(f"precision {precision:.3f} recall {recall:.3f}", {k: dict(v) for k, v in wrong.items() if v}, {k: dict(v) for k, v in missed.items() if v})
    assert precision >= 0.95 and recall >= 0.95
