"""Main-text extraction with two-pass block rules.

A page is cut into text blocks at block elements.  Regions that are never article text (menus,
page headers and footers, sidebars, notices, adverts, forms, scripts, styles, comments) are known
by element, role or class words and dropped.  Pass one classifies every other block by itself:
link density, length and stop-word density make it good, bad, or undecided when it is short.
Pass two gives undecided blocks the label of their nearest decided neighbours.  An article or main element is
evidence only: a block inside needs fewer stop words to be good and is undecided, not bad, without them; undecided
blocks look at the neighbours on their own side of its edge, and where none is decided, or inside where these
differ, the edge decides.  Low stop-word density says nothing on tables and code, nor on pages in a language
without a list (few stop words in all): such blocks are undecided.  An article in a dropped region (teasers) stays
dropped, unless the page has no good block elsewhere.

Defined cases: null or empty html gives an empty text; a page without any good block gives its
undecided blocks; unclosed or stray tags are tolerated; whole pages of any length; rows come back
one for one, so repeated rows and null ids stay; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import ship

# Elements that cut blocks, never have content, or never hold article text.
BLOCK = set("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure "
            "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table "
            "tbody tfoot thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
DROP = set("script style noscript template head title svg math iframe object canvas audio video form button select "
           "textarea nav footer aside menu dialog".split())
DROP_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
                 "toolbar tablist".split())
DROP_WORDS = set("nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead ad ads advert adverts "
                 "advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
                 "notices popup modal overlay newsletter subscribe signup share sharing social related recommended "
                 "recommendations login search searchbox pagination pager widget widgets toolbar skip".split())
COMMENT_WORDS = set("comment comments disqus reply replies respond discussion".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Frequent function words (English, German, French, Spanish).
STOP_WORDS = set("""
the of and to in a is that it for as was with be by on not he his but at are this have from or had an they which you
were all her she there would their we him been has when who will no more if out so said what up its about
der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie
nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man
de la le et les un une du en est pour qui dans par sur au pas plus ne se ce il sont avec son que mais comme ou si
leur y dont aux cette ces être fait elle nous vous ils deux même
el los del las con no su para al lo como más pero sus ha me sin sobre este ya entre cuando todo esta ser son dos
también fue había era muy años hasta desde está mi porque
""".split())
SHORT, LONG = 70, 200  # characters: shorter blocks are undecided, longer ones need fewer stop words
STOP_LOW, STOP_HIGH, LINKS = 0.15, 0.30, 0.4
LOOSE = {"pre", "code", "table"}  # text without sentences


class _Blocks(HTMLParser):
    """Blocks ``[text, link_chars, in_article, heading, loose]`` of the regions that can hold article text."""

    def __init__(self, teasers: bool):
        super().__init__(convert_charrefs=True)
        self.teasers = teasers  # articles in dropped regions count
        self.held_back = False
        self.stack: list[tuple[str, str, bool]] = []  # element, why dropped ('', 'soft', 'hard'), in article
        self.blocks: list[tuple[str, int, bool, bool, bool]] = []
        self.text: list[str] = []
        self.link_chars = self.links = 0
        self.heading = False

    def _cut(self):
        text = " ".join("".join(self.text).split())
        if text:
            self.blocks.append((text, self.link_chars, bool(self.stack) and self.stack[-1][2], self.heading,
                                any(s[0] in LOOSE for s in self.stack)))
        self.text, self.link_chars, self.heading = [], 0, False

    def _why(self, tag, attrs, above, article):
        if tag in DROP or above == "hard":
            return "hard"
        a = {k: (v or "").lower() for k, v in attrs}
        words = set(re.split(r"[^a-z0-9]+", a.get("class", "") + " " + a.get("id", "")))
        role = a.get("role", "")
        if words & COMMENT_WORDS or "hidden" in a or "display:none" in a.get("style", "").replace(" ", ""):
            return "hard"
        if tag in ("html", "body"):
            return above
        if role in DROP_ROLES or words & DROP_WORDS:
            return "soft"
        if not article and (tag == "header" or "header" in words and not words & {"post", "entry", "article"}):
            return "soft"
        if tag == "article" and above and not self.teasers:
            self.held_back = True
            return above
        return "" if tag in ("article", "main") or role == "main" else above

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._cut()
            if self.stack and self.stack[-1][0] in ("p", *HEADINGS) and tag != "hr":
                self.stack.pop()
            elif tag in ("p", "li", "tr", "dt", "dd"):
                self._close_open(tag)
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        _, above, article = self.stack[-1] if self.stack else ("", "", False)
        why = self._why(tag, attrs, above, article)
        inside = article or tag in ("article", "main") or dict(attrs).get("role") == "main"
        self.stack.append((tag, why, inside))
        if tag == "a":
            self.links += 1
        if tag in ("td", "th"):
            self.text.append(" ")
        if tag in HEADINGS:
            self.heading = True

    def _close_open(self, tag):
        """An open element of the same kind ends, unless a container stands between."""
        for i in range(len(self.stack) - 1, -1, -1):
            t = self.stack[i][0]
            if t == tag:
                del self.stack[i:]
                return
            if t in BLOCK or t in ("td", "th"):
                return

    def handle_startendtag(self, tag, attrs):
        if tag in VOID or tag in BLOCK:
            self.handle_starttag(tag, attrs)
            if tag not in VOID:
                self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self._cut()
        if tag == "a":
            self.links = max(0, self.links - 1)
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return
            if tag not in BLOCK and self.stack[i][0] in BLOCK:
                return  # a stray inline end does not close blocks

    def handle_data(self, data):
        if self.stack and self.stack[-1][1]:
            return
        self.text.append(data)
        if self.links:
            self.link_chars += len(data)


def blocks_of(html: str | None, teasers: bool = False) -> tuple[list[tuple[str, int, bool, bool, bool]], bool]:
    """The blocks, and whether an article in a dropped region was held back."""
    p = _Blocks(teasers)
    p.feed(html or "")
    p.close()
    p._cut()
    return p.blocks, p.held_back


def stop_words(text: str) -> tuple[int, int]:
    """Stop words and words of a text."""
    words = text.lower().split()
    return sum(w.strip(".,;:!?()\"'") in STOP_WORDS for w in words), len(words)


def first_pass(text: str, link_chars: int, article: bool, heading: bool, loose: bool, density: float, listed: bool) -> str:
    """'good', 'bad' or '' (undecided) from the block alone, its stop-word density and whether the page's language is listed."""
    if link_chars > LINKS * len(text):
        return "bad" if not heading else ""
    if heading or len(text) < SHORT:
        return ""
    if density >= STOP_HIGH or ((article or len(text) >= LONG) and density >= STOP_LOW):
        return "good"
    return "" if density >= STOP_LOW or article or loose or not listed else "bad"


def second_pass(blocks, first: list[str]) -> list[str]:
    """Labels of all blocks: undecided ones by their nearest decided neighbours on their side of an article's edge."""
    marked = any(b[2] for b in blocks)
    out = list(first)
    for side in (True, False):
        own = [i for i, b in enumerate(blocks) if b[2] == side]
        decided = [i for i in own if first[i]]
        alone = "good" if side or not marked else "bad"
        if side and all(first[i] == "bad" for i in decided):
            decided = []  # link lists alone say nothing on the rest of an article
        at = 0
        for i in own:
            if first[i]:
                continue
            while at < len(decided) and decided[at] < i:
                at += 1
            after = decided[at] if at < len(decided) else None
            before = decided[at - 1] if at else None
            if before is None and after is None:
                out[i] = alone
            elif before is None or after is None:
                out[i] = first[after if before is None else before]
                if side and out[i] == "bad":
                    out[i] = "good"  # at an article's edge
            elif first[before] == first[after]:
                out[i] = first[before]
            elif side:
                out[i] = "good"
            elif blocks[i][3]:
                out[i] = first[after]  # a heading goes with what follows it
            else:
                out[i] = first[before if i - before <= after - i else after]
    return out


def main_text(html: str | None) -> str:
    """The good blocks of a page, joined by blank lines."""
    blocks, held_back = blocks_of(html)
    for again in (False, True):
        counts = [stop_words(b[0]) for b in blocks]
        long = [c for b, c in zip(blocks, counts) if len(b[0]) >= SHORT and b[1] <= LINKS * len(b[0]) and not b[4]]
        listed = sum(s for s, _ in long) >= STOP_LOW * sum(n for _, n in long)
        first = [first_pass(*b, s / max(1, n), listed) for b, (s, n) in zip(blocks, counts)]
        if "good" in first or not held_back or again:
            break
        if any(f != "bad" and len(b[0]) >= SHORT for b, f in zip(blocks, first)):
            break
        blocks, _ = blocks_of(html, teasers=True)  # nothing else can be the main text
    if "good" not in first and not any(b[2] for b in blocks):
        return "\n\n".join(b[0] for b, f in zip(blocks, first) if f != "bad")
    return "\n\n".join(b[0] for b, f in zip(blocks, second_pass(blocks, first)) if f == "good")


def extract_main_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` without the html and with its main text in ``out_col`` (replacing a column of that name)."""
    ship(pages.sparkSession)

    @F.pandas_udf("string")
    def pull(html):
        return html.map(lambda h: main_text(h), na_action=None)

    keep = [c for c in pages.columns if c not in (html_col, out_col)]
    return pages.select(*[pages[f"`{c}`"] for c in keep], pull(pages[f"`{html_col}`"]).alias(out_col))
