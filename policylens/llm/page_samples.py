"""Labelled pages from which the extractor learns layouts: ``data-main="1"`` marks content, ``"0"`` what inside or beside it is none.

Written for this library, one for each common way to lay out a page; the
texts say nothing in particular.
"""

PAGES = (
    # a blog: header, menu, article with list and quotation, comments, sidebar
    """<html><head><title>River walks</title><style>p{}</style></head><body><header class="site-header"><a href="/">The Walker</a><p>Notes from the road, since 1999.</p></header>
<nav class="menu"><ul><li><a href="/a">Home</a></li><li><a href="/b">Maps</a></li><li><a href="/c">Contact</a></li></ul></nav>
<main data-main="1"><h1>River walks</h1><p>The path follows the water for nine miles, and there is shade nearly all the way.</p><p>Bring:</p><ul><li>water</li><li>a map</li>
<li>good <a href="/s">shoes</a></li></ul><h2>Where to start</h2><p>Start at the mill. The old bridge is closed, so cross by the ferry; it runs every hour.</p><blockquote><p>Nobody walks it twice the same way.</p></blockquote>
<p>Short.</p></main><section id="comments" data-main="0"><h3>2 comments</h3><ol class="comment-list"><li><p>I walked it last May and loved every mile of it, thank you for writing this.</p></li>
<li><p>The ferry did not run on Sunday. Check before you go!</p></li></ol><form><label>Your name</label><input><p>Your address will not be shown to other readers.</p><button>Send</button></form></section>
<aside class="sidebar"><h4>Popular</h4><ul><li><a href="/1">Ten hills you should climb</a></li><li><a href="/2">Rain gear compared</a></li></ul><p>The author lives by the sea and writes about walking, weather and maps.</p></aside>
<footer><p>&copy; The Walker. All rights reserved. No part may be copied.</p></footer></body></html>""",
    # a news site of divs only, with an advert inside the story
    """<body><div class="topbar"><span>Monday</span> <a href="/l">Log in</a></div><div id="nav"><a href="/w">World</a> | <a href="/s">Sport</a> | <a href="/m">Money</a></div>
<div class="cookie-notice"><p>We use cookies to improve this site. By going on you accept our policy.</p><button>Accept</button></div><div class="breadcrumbs"><a href="/">Home</a> &gt; <a href="/w">World</a></div>
<div class="story-content" data-main="1"><h1>Harbour to be dredged</h1><div class="text"><p>The council decided on Tuesday that the harbour will be dredged next spring, at a cost of four million.</p>
<div class="ad" data-main="0"><p>Buy two pairs of boots and get the third one free. Only this week.</p></div><p>Work begins in March. Fishing boats will use the north pier until then.</p><p>&quot;It is about time,&quot; said one skipper.</p></div></div>
<div class="related" data-main="0"><h3>Read next</h3><ul><li><a href="/3">Storm closes the coast road for a second day</a></li><li><a href="/4">Ferry prices go up again</a></li></ul></div>
<div class="share"><a href="/f">Share</a> <a href="/t">Post</a></div><div id="footer"><a href="/about">About</a> <a href="/terms">Terms</a> Printed by the Harbour Press.</div></body>""",
    # article element with header, footer and figure of its own
    """<body><nav><a href="/">Start</a><a href="/x">Topics</a></nav><article data-main="1"><header><h1>On bread</h1></header><p>Flour, water, salt and time: that is all.</p><figure><img src="b.jpg">
<figcaption>A loaf after one hour.</figcaption></figure><p>Mix them in the evening, and let the dough rest in a cool place until the morning; it will be twice its size.</p><aside data-main="0" class="promo"><p>Our book of loaves is out now, order it today.</p></aside>
<h2>Baking</h2><p>Heat the oven well before.</p><table><tr><th>Loaf</th><th>Minutes</th></tr><tr><td>small</td><td>25</td></tr><tr><td>large</td><td>40</td></tr></table><footer data-main="0"><a href="/tags/bread">bread</a> <a href="/tags/oven">oven</a></footer></article>
<footer>&middot; Imprint &middot; Privacy</footer></body>""",
    # a forum-like page where the first text is the article
    """<body><div id="header"><h2><a href="/">Questions on gardens</a></h2><form action="/search"><input name="q"><input type="submit" value="Search"></form></div><div id="content" data-main="1"><h1>Moss in the lawn</h1>
<p>Moss grows where the ground is wet, shaded or poor. Remove it in autumn, feed the grass, and cut it less short than you did.</p><p>Lime helps only where the soil is sour.</p></div>
<div class="replies" data-main="0"><div class="reply"><p>We had moss for years until we cut down the big pine, then it went away by itself.</p></div><div class="reply"><p>Thanks, that helped.</p></div></div>
<div class="widget"><p>Join our newsletter and get one letter a month.</p><form><input type="email"><label>E-mail</label></form></div><div class="footer">All times are local. &copy; Garden board</div></body>""",
    # hardly any attributes
    """<body><table><tr><td><a href="/1">One</a><br><a href="/2">Two</a><br><a href="/3">Three</a></td><td data-main="1"><h1>A short history of the lamp</h1><p>The first lamps were stones with a hollow for fat. They smoked, and they stank.
<p>Oil came later, with a wick of linen, and after it gas, which lit whole streets at the turn of a tap.<p>Then came the wire.</td></tr></table><p><small>Last changed in June. Mail the <a href="m">editor</a>.</small></p></body>""",
    # an article with unclosed inline markup, advert before and links after
    """<!DOCTYPE html><body><ul><li><a href="/q">Weather</a></li><li><a href="/r">Roads</a></li></ul><div class="advert">New tyres for the winter, fitted while you wait. Call us.</div><article data-main="1"><h1>Snow</h1><p><b>It snowed.<br>
<p>Drifts of two metres closed the pass on Sunday night, and the plough did not come through until noon.</p><p><b>More is expected.<br></article><div><h4>Also interesting</h4><a href="/5">How to drive on ice</a> <a href="/6">Chains</a></div>
<footer>&copy; example.org &middot; Words of no weight, in a row. And some more.</footer></body>""",
    # a page with a dialog, a sign-up box and a paywall notice in the middle
    """<body><div role="banner"><a href="/">Daily</a></div><div role="dialog" class="consent"><h2>Your privacy</h2><p>We and our partners store information on your device. You can change your choice at any time.</p><button>Agree</button></div>
<div role="main" data-main="1"><h1>The clock tower</h1><p>For a hundred years its bell has rung at noon; on Friday it stayed silent for the first time, as the rope had been stolen.</p><div class="signup" data-main="0"><h3>Do not miss a story</h3><p>Enter your address and we will write to you.</p>
<form><input></form></div><p>A new rope was found by the evening.</p><div class="notice paywall" data-main="0"><p>You have read three of your five free stories this month.</p></div></div><div role="complementary"><h3>Trending</h3><ol><li><a href="/8">Goat on the roof</a></li>
<li><a href="/9">Mayor's new hat</a></li></ol></div><div role="contentinfo">Publisher: Daily House, 1 High Street.</div></body>""",
    # text only
    """<p data-main="1">A page may hold nothing but a paragraph, without a menu and without an end.</p>""",
    """<html><body><pre data-main="1">Dear all,
the meeting is moved to Thursday, ten o'clock, in the small room. Please tell the others.</pre></body></html>""",
    # no text worth keeping
    """<body><nav><ul><li><a href="/1">Up</a></li><li><a href="/2">Down</a></li></ul></nav><form><label>Name</label><input><label>Password</label><input><p>Forgotten your password? Ask for a new one.</p></form><footer>&copy; 2020</footer></body>""",
    """<body><header><a href="/">Shop</a></header><div class="menu"><a href="/a">Cups</a><a href="/b">Plates</a></div><div class="banner"><p>Everything at half price until Sunday evening, while it lasts.</p></div><footer><p>Terms of trade. Contact. Imprint.</p></footer></body>""",
    # a documentation page with a table of contents and code
    """<body><div class="sidebar toc"><ul><li><a href="#1">Install</a></li><li><a href="#2">Use</a></li><li><a href="#3">Questions</a></li></ul></div><div class="markdown-body" data-main="1"><h1>fold</h1><p>Folds lines at a width.</p><h2>Install</h2><pre>make install</pre>
<p>You need a compiler, and a system that is not older than ten years.</p><h2>Use</h2><dl><dt>-w</dt><dd>the width, 80 if none is given</dd><dt>-s</dt><dd>break at spaces</dd></dl></div><div class="pager"><a href="/p">Previous</a> <a href="/n">Next</a></div>
<div class="colophon">Made with a pencil.</div></body>""",
    # sections as content, reader comments as articles
    """<body><header><nav><a href="/">Index</a> <a href="/i">Issues</a></nav></header><div class="post"><div class="entry" data-main="1"><h2>Three bridges</h2><section><h3>The first</h3><p>It was of wood and burned twice, once by lightning and once by carelessness.</p></section>
<section><h3>The second</h3><p>Stone, four arches; the flood took two of them.</p></section><section><h3>The third</h3><p>Iron. It still stands, painted green, and carries the trains.</p></section></div>
<div class="responses" data-main="0"><article class="comment"><p>My grandfather painted it, and he always said that it was grey before the war.</p></article><article class="comment"><p>Where exactly was the wooden one?</p></article></div></div>
<div class="social"><p>Follow us</p><a href="/y">here</a></div><div class="copyright">Text: see the list of authors. Pictures: public.</div></body>""",
    # long notices at both ends
    """<body><div class="alert"><p>Important: our office is closed from the twenty-fourth to the second. Orders that come in between are sent after that, in the order in which they came.</p></div><article class="hentry" data-main="1"><h1>Bees in town</h1>
<p>There are more kinds of flowers in a town than in the fields around it, and no one sprays them.</p><p>That is why honey from the roofs tastes of lime and chestnut.</p></article><div class="disclaimer"><p>This text is no advice. We do not answer for errors, for links to other pages, or for what others write there.</p></div>
<div class="comments"><p>Be the first to write something.</p></div></body>""",
    # right-to-left order: side column first
    """<body><div class="left-rail"><div class="promo">Fly to the islands from 49, taxes and one bag included.</div><h5>Latest</h5><a href="/1">Small news</a><a href="/2">Other news</a></div><div class="page"><h1 data-main="1">Counting swans</h1><div class="body-text" data-main="1"><p>Every winter a dozen people count the swans between the two locks.</p>
<p>This year there were 214, nine fewer than the year before, but more young ones than ever, the leader of the count says.</p></div><div class="tools"><a href="/print">Print</a> <a href="/mail">Mail</a></div></div></body>""",
    # bare pages
    """<div data-main="1">The well is dry. Go to the next village, it is an hour on foot, and ask there.</div>""",
    """<body data-main="1"><h1>Notes</h1><p>The first note is short.</p><p>The second one says more: it names the day, the place and the price, and ends there.</p></body>""",
    """<html><body data-main="1"><h1>Letter</h1><p>Yes.</p><ul><li>one thing</li><li>another</li></ul></body></html>""",
    """<html><head><title>Tides</title></head><body><div data-main="1"><h2>Tides</h2>They come twice a day, a little later each time.<br>The moon draws them.<p>Spring tides are the highest.</p></div></body></html>""",
    """<p data-main="1">One line and no more of it.""",
    # posts and entries, with what readers wrote below
    """<body><div class="navbar"><a href="/">Blog</a><a href="/old">Archive</a></div><div class="post"><h1 data-main="1">Soup</h1><div class="entry-content" data-main="1"><p>Onions first, slowly, until they are brown; then the stock, a leaf of bay and the bread on top.</p>
<p>It is better on the second day.</p></div><div class="post-tags"><a href="/t/soup">soup</a><a href="/t/winter">winter</a></div><div id="disqus_thread" class="discussion"><h4>Discussion</h4><div class="comment"><p>I add a glass of wine to mine, and my children never notice.</p></div>
<div class="comment"><p>Which bread do you take?</p></div></div></div><div class="site-footer"><p>Written in a kitchen.</p></div></body>""",
    """<body><section class="notice"><p>The site moves to a new address in May. Please change your bookmarks, the old one will end in June.</p></section><main data-main="1"><section><h2>Ice</h2><p>The lake froze in December, and by the new year one could walk across it.</p></section>
<section><h2>Thaw</h2><p>In March it broke with a noise that was heard in the town.</p></section></main><section class="reviews"><h3>What readers say</h3><p>A lovely piece, I could hear the ice.</p></section><section class="sponsored"><p>Skates of steel, sharpened for free for as long as you own them.</p></section></body>""",
)
