"""Main text of web pages from flat text blocks, classified by a small decision tree.

A page is cut into blocks at block-level tags.  A block is described by its words and link density, by those of its
neighbours, and by the kind of container it stands in; a tree of a few splits, grown on a labelled table of the
blocks of the sample pages below, tells article text from the rest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre
section select summary table tbody td tfoot th thead title tr ul""".split())
# Content that is never text of the page.
SILENT = frozenset("script style noscript template iframe svg math object head textarea canvas audio video".split())
BOILER_TAGS = frozenset("nav footer aside form header dialog menu button select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER_NAME = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|header|login|"
                         r"masthead|menu|nav\w*|newsletter|notices?|paywall|popup|promo\w*|related|replies|respond|share|sharing|"
                         r"sidebar|signup|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-])", re.I)
_SPACE = re.compile(r"\s+")
FEATURES = ("words", "links", "words before", "links before", "words after", "links after", "boilerplate container",
            "article container", "heading")


class Blocks(HTMLParser):
    """Blocks ``[text, linked characters, in boilerplate, in article, heading]`` of one page, broken markup included."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[list] = []
        self.open: list[tuple[str, bool]] = []
        self.text: list[str] = []
        self.linked = self.anchors = self.silent = self.boiler = self.article = 0
        self.heading = False

    def flush(self):
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.found.append([text, self.linked, self.boiler > 0, self.article > 0, self.heading])
        self.text, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK_TAGS:
            self.flush()
            self.heading = len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
        elif tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        if tag == "body":  # an unclosed head ends here
            self.silent = 0
            self.open = [(t, b) for t, b in self.open if t not in SILENT]
        named = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        boiler = tag not in ("html", "body", "article", "main") and (
            tag in BOILER_TAGS and not (tag == "header" and self.article)
            or (tag in BLOCK_TAGS or tag == "span") and bool(BOILER_NAME.search(named)))
        if tag == "p" or tag == "li":  # these close their like
            self._close_to(tag, stop=("ul", "ol", "div", "article", "section", "body", "td", "main", "nav", "aside", "footer", "form"))
        self.open.append((tag, boiler))
        self.silent += tag in SILENT
        self.anchors += tag == "a"
        self.article += tag in ("article", "main")
        self.boiler += boiler

    def _close_to(self, tag, stop=()):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                for t, b in self.open[i:]:
                    self.silent -= t in SILENT
                    self.anchors -= t == "a"
                    self.article -= t in ("article", "main")
                    self.boiler -= b
                del self.open[i:]
                return
            if self.open[i][0] in stop:
                return

    def handle_endtag(self, tag):
        if tag in BLOCK_TAGS:
            self.flush()
            self.heading = False
        self._close_to(tag)

    def handle_data(self, data):
        if not self.silent:
            self.text.append(data)
            if self.anchors:
                self.linked += len(data.strip())

    @classmethod
    def of(cls, html: str) -> list[list]:
        parser = cls()
        parser.feed(html)
        parser.close()
        parser.flush()
        return parser.found


def features(found: list[list]) -> np.ndarray:
    """One row per block in the order of ``FEATURES``; beyond the page's ends stand blocks without words."""
    own = np.array([(len(t.split()), min(1.0, n / max(1, len(t)))) for t, n, *_ in found], dtype=float).reshape(-1, 2)
    padded = np.vstack([np.zeros((1, 2)), own, np.zeros((1, 2))])
    kind = np.array([b[2:] for b in found], dtype=float).reshape(-1, 3)
    return np.hstack([own, padded[:-2], padded[2:], kind])


# Sample pages; a block is labelled 1 (article) where its text starts with "+", 0 where it starts with "-".
SAMPLES = (
    "<nav><ul><li><a href=x>-Home</a><li><a href=x>-World news</a><li><a href=x>-Sport</a></ul></nav><div class=ad>-Buy a new lamp "
    "today and save ten percent on it</div><article><h1>+River rises again after a week of rain</h1><p>+The river rose by two "
    "metres in the night and closed the old bridge for all traffic.<p>+No one was hurt.<p>+Engineers will look at the bridge on "
    "Monday, the town said, and will keep it shut until the water has gone down again.</article><footer>-Copyright by the paper, "
    "all rights reserved</footer>",
    "<header><a href=x>-The daily page</a><p>-Weather today: sunny and dry all day</header><main><h1>+A short walk</h1><p>+It was late."
    "<p>+We walked along the wall to the sea and <a href=x>+sat down</a> on the warm stones, where nobody had been since the spring.</p>"
    "<ul><li>+Bring water and a hat for the way<li>+Start early</ul></main><aside><h3>-Most read</h3><ul><li><a href=x>-Ten roads to drive"
    " before winter comes</a><li><a href=x>-A recipe for bread</a></ul></aside>",
    "<div id=menu><a href=x>-One</a> <a href=x>-Two</a></div><div><h2>+How the clock works</h2><p>+A weight pulls a cord, the cord turns a "
    "wheel, and a small anchor lets the wheel go on by one tooth at every swing.</p><p>+That is all there is to it, though the making takes "
    "months of patient work by hand.</p></div><div class=comments><p>-Great article, I have had one of these in my hall for some forty years"
    " and it still runs.</p><p>-Thanks!</p></div><form><p>-Write a comment here and send it to us by the button</p></form>",
    "<div class='cookie notice'>-We use cookies to make this page better, please agree to all of them now</div><section><p>+The council met "
    "on Tuesday and voted for the new school by nine votes to four.</p><p>+Work begins in May.</p><p>+The old building will become a library "
    "with a garden behind it, open to all.</p></section><div><a href=x>-Next</a> <a href=x>-Previous</a> <a href=x>-Index of all pages</a></div>"
    "<p class=footer>-Imprint</p>",
    "<table><tr><td><a href=x>-Start</a><td><a href=x>-Shop</a></table><p>+There are three kinds of reed in the bay, and only one of them is good "
    "for a roof that has to last.</p><h3>+Cutting</h3><p>+They cut it in January, when the frost has dried the stems and the birds are gone.</p>"
    "<div class='share social'>-Share this page with your friends</div><div class=related-posts><p><a href=x>-The birds of the bay and where to "
    "see them in winter</a></div><footer><p>-Published by the museum society, founded in the year 1901, street and town</footer>",
    "<div><a href=x>-Harbour</a></div><div>-Topics of the day</div><div><a href=x>-Market</a></div><div>-More</div><div><a href=x>-Theatre and "
    "music</a></div><h1>+A bell for the tower</h1><p>+The new bell weighs two tons and will ring for the first time at noon on Sunday.</p>"
    "<p>+The street stays closed.</p><p>+Its predecessor cracked in the frost of last winter and was melted down in the foundry.</p>",
    "<ul><li><a href=x>-Home</a><li><a href=x>-Archive</a></ul><p>+Snow fell on the hills in the night, the first of this year.</p><p>+It "
    "will not stay.</p>",
    "<p>+One line is all this page has to say.</p>",
    "<article><header><h1>+What the map left out</h1><p>+By our reporter in the north</header><p>+For a hundred years the map showed a lake "
    "where there was only grass.</p><blockquote>+Nobody asked us</blockquote><p>+said the farmer, whose family had been there longest of "
    "all.</p></article><div class=newsletter>-Get our letter every week, free of charge and full of good reading for you</div>",
)


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of every block of the sample pages."""
    rows, labels = [], []
    for page in SAMPLES:
        found = Blocks.of(page)
        labels += [int(b[0].startswith("+")) for b in found]
        rows.append(features(found))
    return np.vstack(rows), np.array(labels)


def grow_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 6, least: int = 1):
    """A tree by Gini impurity: ``(feature, threshold, lower, upper)`` or a leaf's share of article blocks."""
    share = float(labels.mean())
    if depth == 0 or share in (0.0, 1.0):
        return share
    best = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for t in (values[:-1] + values[1:]) / 2:
            low = rows[:, f] <= t
            if least <= low.sum() <= len(low) - least:
                a, b = labels[low], labels[~low]
                impurity = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, f, float(t), low)
    if best is None:
        return share
    _, f, t, low = best
    return f, t, grow_tree(rows[low], labels[low], depth - 1, least), grow_tree(rows[~low], labels[~low], depth - 1, least)


def classify(tree, rows: np.ndarray) -> np.ndarray:
    """Whether each block belongs to the article."""
    if not isinstance(tree, tuple):
        return np.full(len(rows), tree >= 0.5)
    f, t, low, high = tree
    below = rows[:, f] <= t
    result = np.empty(len(rows), dtype=bool)
    result[below], result[~below] = classify(low, rows[below]), classify(high, rows[~below])
    return result


def main_text(html: str, tree) -> str:
    found = Blocks.of(html)
    keep = classify(tree, features(found)) if found else []
    return "\n\n".join(b[0] for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, html="html", keep=("page_id", "url"), tree=None) -> DataFrame:
    """``keep`` columns with ``text`` and ``n_chars`` (code points), one row per page, in one pass without a shuffle.

    A null or empty page has an empty text.  Repeated pages give repeated rows; other columns are ignored.
    """
    tree = tree if tree is not None else grow_tree(*labelled_table())

    @F.pandas_udf("string")
    def text_of(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: main_text(page, tree))

    found = pages.select(*keep, text_of(F.coalesce(F.col(html), F.lit(""))).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
