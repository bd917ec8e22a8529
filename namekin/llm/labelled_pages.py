"""Labelled pages: skeletons of common page layouts whose main text is marked ``data-keep``.

``{p}`` stands for a paragraph, ``{s}`` for a short phrase; both are filled with text of sampled pages.
"""

SKELETONS = (
    '<body><nav><ul><li><a href="/">{s}</a></li><li><a href="/">{s}</a></li></ul></nav><div class="ad">{s}</div>'
    '<article data-keep="1"><h1>{s}</h1><p>{p}</p><p>{p}<p><b>{p}<br></article><footer>&copy; {s}</footer></body>',
    '<body><header><h2>{s}</h2><p>{s}</p></header><main><article data-keep="1"><h1>{s}</h1><p>{p}</p><ul><li>{s}</li>'
    '<li>{p}</li></ul><p>{p}</p></article><section class="comments"><h3>{s}</h3><p>{p}</p><p>{p}</p></section></main>'
    '<aside class="sidebar"><h3>{s}</h3><p>{p}</p></aside><footer><p>{s}</p></footer></body>',
    '<body><div id="header"><a href="/">{s}</a></div><div id="menu"><a href="/">{s}</a> <a href="/">{s}</a></div>'
    '<div id="content" data-keep="1"><h1>{s}</h1><p>{p}</p><blockquote>{p}</blockquote><p>{p}</p></div>'
    '<div id="sidebar"><p>{p}</p><ul><li><a href="/">{s}</a></li></ul></div><div id="footer">{s}</div></body>',
    '<body><div class="cookie notice"><p>{p}</p><button>{s}</button></div><div class="nav"><a href="/">{s}</a></div>'
    '<div class="post"><div class="entry body" data-keep="1"><h2>{s}</h2><p>{p}</p><p>{p}</p></div>'
    '<div id="comments"><div class="comment"><p>{p}</p></div><div class="comment reply"><p>{p}</p></div></div></div>'
    '<form><label>{s}</label><p>{s}</p></form><div class="footer"><p>{s}</p></div></body>',
    '<body><header class="site"><nav><a href="/">{s}</a></nav></header><main data-keep="1"><h1>{s}</h1><p>{p}</p>'
    '<h2>{s}</h2><p>{p}</p><pre>{p}</pre></main><aside><div class="related"><h4>{s}</h4><p>{p}</p></div></aside>'
    '<div class="newsletter signup"><form><p>{p}</p></form></div><footer><ul><li>{s}</li></ul></footer></body>',
    '<body><div class="banner promo"><p>{p}</p></div><article><header><a href="/">{s}</a></header><div data-keep="1">'
    '<h1>{s}</h1><p>{p}</p><p>{p}</p><table><tr><td>{s}</td><td>{s}</td></tr></table><p>{p}</p></div>'
    '<div class="share social"><a href="/">{s}</a></div><aside class="ad advert"><p>{p}</p></aside>'
    '<footer><p>{s}</p></footer></article><div class="comments"><p>{p}</p></div></body>',
    '<body><nav class="menu"><ul><li>{s}</li><li>{s}</li><li>{s}</li></ul></nav><div class="article story text" data-keep="1">'
    '<h1>{s}</h1><p>{p}</p><p>{p}</p><p>{p}</p></div><section id="respond"><h3>{s}</h3><form><p>{s}</p></form></section>'
    '<div class="breadcrumb"><a href="/">{s}</a> {s}</div><footer>{s} &middot; {p}</footer></body>',
    '<body><div role="navigation"><a href="/">{s}</a></div><div role="main" data-keep="1"><h1>{s}</h1><p>{p}</p>'
    '<dl><dt>{s}</dt><dd>{p}</dd></dl></div><div role="complementary"><p>{p}</p></div><div role="contentinfo"><p>{s}</p></div></body>',
    '<body><ul class="nav"><li><a href="/">{s}</a></li></ul><section class="advertisement sponsored"><p>{p}</p></section>'
    '<article data-keep="1"><p>{p}</p><p>{p}</p><h3>{s}</h3><p>{s}</p></article><section class="comments"><article><p>{p}</p>'
    '</article><article><p>{s}</p></article></section><div class="notice alert"><p>{p}</p></div></body>',
    '<body><div class="popup modal"><p>{s}</p></div><div class="wrapper"><div class="main content"><div data-keep="1"><h1>{s}</h1>'
    '<p>{p}</p><ol><li>{p}</li><li>{s}</li></ol><p>{p}</p></div><div class="tags meta"><a href="/">{s}</a></div></div>'
    '<div class="widget side"><p>{p}</p></div></div><div class="copyright legal"><p>{p}</p></div></body>',
    '<body><nav>{s}</nav><article data-keep="1"><h1>{s}</h1><p>{p}</p></article><aside>{p}</aside><footer>{s}</footer></body>',
    '<body><header>{s}</header><nav>{s}</nav><main data-keep="1"><p>{p}</p><div>{p}</div></main><aside><p>{p}</p></aside>'
    '<footer><p>{p}</p></footer></body>',
    '<body><div class="menu">{s}</div><main data-keep="1"><h1>{s}</h1><div>{p}</div><p>{p}</p></main><aside><p>{s}</p></aside>'
    '<form><p>{p}</p></form></body>',
    '<body><div class="nav">{s}</div><div class="post" data-keep="1"><h1>{s}</h1><div>{p}</div></div><div class="comments">'
    '<div>{p}</div><div>{s}</div></div><div class="sidebar">{p}</div><div class="ad">{p}</div></body>',
)
