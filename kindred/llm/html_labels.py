"""The small labelled table of HTML extraction: pages whose blocks are marked + (text of the article) or - (not).

``{+12}`` stands for a marked block of twelve words, ``{12}`` for twelve words more in the same block. The markup is our own.
"""

from __future__ import annotations

import re

_SLOT = re.compile(r"\{([+-]?)(\d+)\}")


def _words(m: re.Match) -> str:
    return " ".join(([m[1]] if m[1] else []) + ["word"] * (int(m[2]) - bool(m[1])))


#: Layouts; a page is one of them with its class names filled in.
_LAYOUTS = {
    # an article element says where the text is
    "article": """<html><head><title>t</title></head><body><nav><ul><li><a>{-1}</a><li><a>{-2}</a><li><a>{-1}</a></ul></nav>
<div class="%(bad)s">{-14}</div><article><h1>{+8}</h1><p>{+60}</p><p>{+9}</p><p><b>{+4}</b><p>{+35} <a>{6}</a> {20}</p><ul><li>{+7}</li><li>{+12}</li><li><a>{+5}</a></li></ul>
<h2>{+3}</h2><p>{+1}</p><p>{+110}</p></article><div class="%(bad)s"><p>{-40}</p></div><footer><p>{-9}</p></footer></body></html>""",
    "nested": """<body><header><a>{-2}</a><p>{-6}</p></header><main><h1>{+7}</h1><article><header><h2>{+6}</h2><p>{+5}</p></header><p>{+45}</p>
<div class="%(bad)s"><p>{-28}</p><p>{-5}</p></div><p>{+70}</p><aside><h3>{-3}</h3><p>{-30}</p></aside><blockquote>{+22}</blockquote><p>{+15}</p><p><a>{+3}</a></p></article>
<section><h2>{-2}</h2><ol><li><article><p>{-4}</p><p>{-18}</p></article></li><li><article><p>{-4}</p><p>{-25}</p></article></li></ol></section></main>
<aside><p>{-12}</p><p>{-33}</p></aside><footer><a>{-1}</a> <a>{1}</a><p>{-20}</p></footer></body>""",
    "teasers": """<body><nav><a>{-1}</a></nav><article class="%(good)s"><h1>{+9}</h1><p>{+80}</p><p>{+55}</p><p>{+6}</p><div class="%(bad)s">{-16}</div><p>{+66}</p></article>
<div><article><h3><a>{-6}</a></h3><p>{-15}</p></article><article><h3><a>{-5}</a></h3><p>{-19}</p></article></div><p>{-30}</p><form><p>{-6}</p><p>{-2}</p></form></body>""",
    "main": """<body><div class="%(bad)s"><a>{-2}</a> {4}</div><main class="%(good)s"><h1>{+5}</h1><p>{+30}</p><table><tr><td>{+2}</td><td>{+1}</td></tr><tr><td>{+3}</td><td>{+1}</td></tr></table><p>{+18}</p>
<p>{+90}</p><form><p>{-4}</p><p>{-3}</p></form><div class="%(bad)s"><p>{-21}</p><p>{-50}</p></div></main><footer>{-7}</footer></body>""",
    "stub": """<body><nav><ul><li><a>{-3}</a></li></ul></nav><article><h1>{+6}</h1><p>{+11}</p></article><div>{-24}</div><footer>{-5} <a>{2}</a></footer></body>""",
    # no such element: names and shallow features alone
    "plain": """<body><div><a>{-1}</a> <a>{1}</a> <a>{2}</a></div><h1>{+8}</h1><p>{+50}</p><p>{+24}</p><p>{+12}</p><p>{+75} <a>{3}</a> {10}</p><h2>{+4}</h2><p>{+31}</p>
<ul><li>{+9}</li><li>{+14}</li></ul><p>{+40}</p><div><a>{-3}</a></div><div><a>{-4}</a> <a>{3}</a></div><div>{-6}</div></body>""",
    "named": """<body><div class="%(bad)s"><ul><li><a>{-1}</a></li><li><a>{-2}</a></li></ul></div><div class="%(bad)s"><p>{-30}</p><p>{-8}</p></div><div class="%(good)s"><h1>{+7}</h1><p>{+44}</p><p>{+3}</p>
<p>{+20}</p><div class="%(bad)s"><p>{-26}</p></div><p>{+61}</p><p><a>{+4}</a></p></div><div class="%(bad)s"><h3>{-2}</h3><p>{-45}</p><p>{-12}</p></div><div class="%(bad)s">{-9}</div></body>""",
    "form": """<body><form><div><a>{-2}</a> <a>{1}</a></div><h1>{+6}</h1><p>{+55}</p><p>{+38}</p><p>{+13}</p><p>{+72}</p><div><a>{-5}</a></div></form></body>""",
    "contact": """<body><div><a>{-2}</a></div><h1>{+5}</h1><p>{+64}</p><p>{+33}</p><form><p>{-3}</p><p>{-2}</p><p>{-22}</p><p>{-4}</p></form><p>{+48}</p><div>{-5} <a>{2}</a></div></body>""",
    "bare": """<p>{+30}</p><p>{+45}</p><p>{+16}</p>""",
    "note": """<div>{+25}</div>""",
    "line": """<p>{+4}</p>""",
    "links": """<body><ul><li><a>{-2}</a></li><li><a>{-3}</a></li><li><a>{-1}</a></li></ul><h2>{-2}</h2><ul><li><a>{-4}</a> {1}</li><li><a>{-6}</a></li></ul><div>{-3}</div></body>""",
    "sides": """<body><header><p>{-12}</p></header><nav><p>{-30}</p></nav><div><h1>{+9}</h1><p>{+58}</p><p>{+41}</p></div><aside><h2>{-2}</h2><p>{-47}</p></aside><dialog><p>{-28}</p></dialog><footer><p>{-60}</p></footer></body>""",
}
#: Names that pages give to what is not the article, and to the article.
_BAD = """ad ads advert advertisement sponsored promo banner sidebar widget menu navbar breadcrumb footer masthead topbar comments comment comment-list
respond cookie consent notice notification alert popup modal newsletter subscribe signup login share social related recommended pagination copyright disclaimer""".split()
_GOOD = "content article post entry story article-body entry-content post-content".split()


def labelled_pages() -> list[str]:
    out = []
    for i, bad in enumerate(_BAD):
        names = {"bad": bad, "good": _GOOD[i % len(_GOOD)]}
        for layout in ("article", "nested", "teasers", "main", "named")[i % 2 :: 2]:
            out.append(_SLOT.sub(_words, _LAYOUTS[layout] % names))
    plain = [k for k in _LAYOUTS if "%(" not in _LAYOUTS[k]]
    return out + [_SLOT.sub(_words, _LAYOUTS[k]) for k in plain for _ in range(2)]
