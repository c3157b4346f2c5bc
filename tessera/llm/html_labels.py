"""Small pages whose text blocks are labelled by hand: the table that the decision tree of html_text.py is grown from.

Each block's text starts with + (main text) or - (the rest). The pages are made up after common layouts: marked and
unmarked articles, menus, teasers, comments, notices, sidebars, and names that only sound like page furniture.
"""

from __future__ import annotations

PAGES = (
    # An article element between menu, advert and footer.
    """<nav><ul><li><a>-Home</a><li><a>-World news</a><li><a>-Sport</a></ul></nav><div class="ad">-Buy two pairs of shoes and get the third one free today.</div>
    <article><h1>+Harbour bridge opens after nine years</h1><p><b>+The new bridge across the harbour opened to traffic this morning.</b><br>
    <p>+Thousands of people had walked across it on Sunday, when it was still closed to cars, and the mayor cut a ribbon at noon.</p>
    <p>+No.</p><ul><li>+Length: 840 metres</li><li>+Cost: 210 million</li></ul><p>+Read <a>the report of the building office</a> for more.</p>
    <p>+Ferries will go on running until the end of the year, as the operator said, but with fewer trips in the evening.</p></article>
    <footer>-Copyright example.org. All rights reserved, including those of translation.</footer>""",
    # The same with a sidebar, an aside, a form and comments inside the article.
    """<header><a>-The Daily Post</a></header><div class="sidebar"><h3>-Most read</h3><ul><li><a>-Storm closes three schools</a><li><a>-Council votes on parks</a></ul></div>
    <main><article><header><h1>+How bees find home</h1><p>+By Ann Field, 3 May</p></header><p>+Bees remember the shape of the skyline above
    the hive, a study of four hundred animals suggests, and not only the position of the sun.</p><aside>-Our editors also suggest this long portrait of a beekeeper in the hills.</aside>
    <p>+"We did not expect it," she said.</p><div class="ad-slot">-Advertisement</div><blockquote>+They fly an arc, stop, look, and then go straight for the entrance.</blockquote><h2>+What comes next</h2>
    <p>+The group plans to repeat the test in a forest, where there is no skyline.</p><form>-Get our letter every morning <input> and never miss a story</form>
    <section class="comments"><h3>-Comments</h3><p>-I have kept bees for thirty years and could have told you that for nothing, but it is nice to read.</p><p>-Great article!</p></section></article></main>
    <footer><p>-About us</p><a>-Contact</a></footer>""",
    # An article with names that only sound like furniture.
    """<div id="top-nav"><a>-Start</a> <a>-Archive</a></div><article><h1>+Notes on search</h1><div class="search-algorithms"><h2>+Binary search</h2><p>+Halving the interval in each
    step takes a number of steps that grows with the logarithm of its length.</p><p>+Simple.</p></div><div class="related-work"><h2>+Related work</h2><p>+The method is old; its first description in print
    had a mistake that went unnoticed for years, and many libraries repeated it.</p><p>+See below.</p></div><div class="share-price"><p>+Shares of the company closed at 41 on Friday after a week without much news from the market.</p>
    <p>+Up 2 percent</p></div><div class="share"><a>-Post</a> <a>-Mail</a> <a>-Print this</a></div><div class="related"><a>-Hash tables in a day</a><br><a>-Why trees grow down</a></div>
    <div class="discussion"><p>+We think that the result holds for other inputs too, though we could not show it for texts with many repeats.</p></div></article>
    <div class="cookie-notice">-We use cookies so that the site works. By staying here you agree with our rules.</div>""",
    # Marked by a name only.
    """<div class="masthead">-Village Gazette</div><div class="breadcrumb"><a>-News</a> <a>-Local</a></div><div class="article-body"><h1>+Well found under market square</h1>
    <p>+Workers who laid a pipe have come upon a well that may be five hundred years old.</p><p>+It is lined with oak.</p><p>+Digging stops until the office for monuments has seen it, which may take until autumn.</p></div>
    <div class="newsletter-signup"><p>-Sign up for our letter and get the week's best stories by mail every Friday afternoon.</p></div>
    <div class="related-posts"><p>-A coin from the river: what a boy found last summer near the old mill.</p></div><div class="site-footer"><p>-Printed in the village since 1911</p></div>""",
    # No marks at all: density, size and neighbours.
    """<body><div><a>-Home</a> <a>-Blog</a> <a>-Photos</a></div><h1>+A walk along the dyke</h1><p>+We left before sunrise, when the reeds were white with frost and nothing moved on the water but two swans.</p>
    <p>+Yes.</p><p>+After an hour the path turned inland and we lost sight of the sea, though one could still hear it when the wind turned.</p><p>+It rained.</p>
    <p>+At noon we sat in the lee of a barn, ate bread and cheese, and counted the geese that came in from the north.</p><div><a>-Older</a> <a>-Newer</a></div><div>-Powered by a small machine</div></body>""",
    """<body><table><tr><td><a>-Index</a><td><a>-Up one level</a></tr></table><h2>+Setting the clock</h2><p>+Turn the wheel at the back until the hands show the time, then press it in until it clicks.</p>
    <h3>+If it stops</h3><p>+Take out the cell, wait a minute, and put it back with the plus sign facing you; the <a>list of parts</a> says which one it needs.</p><ul><li>+Never use force.</li><li>+Keep it dry.</li></ul>
    <p>+Send it to us if that does not help, with a note that says what you did before it stopped.</p><p><a>-Contents</a> | <a>-Next chapter</a></p></body>""",
    """<body><ul><li><a>-Politics</a><li><a>-Economy</a><li><a>-Culture</a><li><a>-Weather</a></ul><div>-Tuesday</div><h1>+Rain at last</h1><div>+After eleven weeks without a drop it rained in the valley on Monday evening, and people
    stood in the street to get wet.</div><div>+The river rose by a hand's breadth.</div><div>+Farmers say that it came too late for the maize but in time for the beet, which will now put on weight until October.</div>
    <h3>-More on this</h3><ul><li><a>-Reservoirs at a low</a><li><a>-How to save water</a><li><a>-Maps of the drought</a></ul><div><a>-Imprint</a> <a>-Privacy</a> <a>-Jobs</a></div></body>""",
    """<body><div><b>-Menu</b></div><div><a>-Sign in</a></div><p>+Dear readers, the shop closes at the end of June after forty years, and I want to tell you why in my own words.</p><p>+I am tired.</p><p>+I am also happy, because my niece
    takes over the bindery and keeps the two presses, so the books will go on being made in this street.</p><p>+Come by.</p><div>-Share</div><div><a>-Facebook</a> <a>-Mail</a></div><div>-Page 1 of 3</div></body>""",
    # Reader comments and notices without an article element.
    """<body><div class="menu"><a>-Recipes</a> <a>-Shop</a></div><h1>+Soup of roast pumpkin</h1><p>+Cut the pumpkin into wedges and roast it with oil and salt until the edges are brown and it yields to a fork.</p><ol><li>+Fry the onion.</li><li>+Add stock and
    the flesh of the pumpkin, and let it all simmer for twenty minutes.</li><li>+Blend.</li></ol><p>+Serve with toasted seeds and a spoon of sour cream for each plate.</p><div id="reader-comments"><p>-We made this twice last week and the children had three
    bowls each, which never happens.</p><p>-Too sweet for me.</p></div><div class="alert">-The shop is closed on Monday because we take stock of all that we have.</div></body>""",
    # Documentation: main element, side menu, a table, code.
    """<aside><a>-Install</a><br><a>-Configure</a><br><a>-Reference</a></aside><main><h1>+Configure</h1><p>+All settings are in one file that is read at the start.</p><pre>+port = 80 host = all</pre><table><tr><th>+Name<th>+Meaning</tr>
    <tr><td>+port<td>+where the server listens</tr></table><p>+<a>Reference</a></p><p>+A change takes effect when the server is started again, or at once if it gets the signal for it.</p><div class="pager"><a>-Install</a> <a>-Reference</a></div></main>
    <footer>-Last built on Sunday</footer>""",
    # A front page: teasers only, none of them main text.
    """<body><div><a>-Home</a> <a>-Local</a> <a>-Sport</a></div><div><a>-Fire in the old brewery: nobody hurt, cause not known yet</a></div><div><a>-Choir wins in Vienna with a song of its own</a></div>
    <div><a>-Five walks for a wet weekend</a> -more</div><div><a>-Tickets</a></div><div>-All rights reserved</div></body>""",
    # An article that is the page's end, after prose that no name marks; its links are part of it.
    """<div>-The museum is open every day but Monday, and on the first Sunday of a month nobody pays at the door.</div><p>-Tickets are sold until five.</p><article><h1>+Sources on the mill</h1><p>+The mill stood
    where the car park is now, and these papers tell of it.</p><ul><li><a>+Tax roll of 1512</a></li><li><a>+A map by hand</a></li><li><a>+Letters</a></li></ul><p><a>+Plan of the wheel</a></p><p>+Thanks to all who helped.</p></article>""",
    """<p>-You are reading a free sample of this magazine; the whole issue can be had in the shop for a small price.</p><article><h2>+Ebb</h2><p>+Grey water</p><p>+slack rope</p><p>+a gull</p><p>+goes</p><p>+inland, where the plough turns up
    worms that are worth the way</p></article><div>-Follow the poet, and find out when new work of the author comes out or is read on a stage.</div><p>-Printed by hand.</p>""",
    """<article><p>+One.</p></article>""",
    """<main><p>+The page that you look for is not here any more.</p></main>""",
    """<article><p><a>+The whole text is a link, as some pages have it.</a></p></article><div><a>-Back</a></div>""",
    # Unmarked pages that start or end with their text.
    """<p>+The lamp in the hall went out last night and has to be replaced before the guests come, so please bring a ladder and two bulbs.</p><p>+Thank you.</p>""",
    """<body><div><a>-Up</a></div><p>+A short page may hold no more than this one paragraph, which says what there is to say and then ends.</p></body>""",
    """<h1>+Minutes</h1><p>+The board met at eight and looked at the accounts, which were found to be in order by the two members who had read them.</p><p>+Nothing else was said.</p><div>-Page 2</div><div><a>-Last year</a></div>""",
    # Long paragraphs before links, in articles and without them.
    """<article><h1>+Canals</h1><p>+Boats were drawn by horses here until the last one was sold in the spring of the year in which the road was built.</p><p>+More is told in these three books, which the library keeps:</p>
    <ul><li><a>+Towpaths</a></li><li><a>+A lock keeper's diary</a></li></ul><p>+The library lends them for four weeks at a time and sends them by post to readers who live further away than the next town.</p><div><a>+Opening hours</a></div></article>""",
    """<body><div><a>-Home</a></div><h1>+Frost</h1><p>+The pears were in flower when it froze for three nights in a row, and nobody in the valley had enough straw to burn.</p><p>+In the morning the petals were brown at the rim, and by the evening
    they lay on the grass, so that it looked as if it had snowed.</p><div><a>-Apples</a> <a>-Plums</a></div></body>""",
    # Articles laid out in divs, and text that starts a page.
    """<article><div>+Ask and answer</div><div>+How deep must the posts stand?</div><div>+A third of their length, and deeper where the ground is soft or the fence high.</div><div>+And in sand?</div><div>+Half.</div><div><a>+See the table of depths</a></div></article>""",
    """<div class="post article"><div>+The first snow fell on the pass tonight and the road will stay closed until the plough has come up from the valley.</div><div>+Drive by the tunnel.</div><div>+It costs nothing until Sunday.</div></div><div>-Weather by the institute</div>""",
    """<body><div>+This text has no head and starts the page with a sentence that is long enough to be read as one.</div><div>+It goes on with a second one, which says that there is no more to come after it.</div><div><a>-Start</a></div></body>""",
    """<main><div><table><tr><td>+Spring<td>+7:10</tr><tr><td>+Summer<td>+5:02</tr></table></div><div>+Times of the first boat, which does not run in winter or when the wind is above eight.</div></main><div>-The pier is private ground.</div>""",
)
