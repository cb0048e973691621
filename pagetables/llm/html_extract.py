"""Main text of a page by a maximum-scoring subsequence of its words and tags.

A page is read as a sequence of tags and words. Tags score negative and words by where they stand: the log odds that
words of the same kind lie inside the content on labelled pages, positive in running text and negative in menus,
adverts or footers. One linear scan finds the contiguous run of tokens with the largest sum; that run is the content.
Inside it, elements that are apart from the article (menus, asides, forms, scripts, reader comments and the like, by tag or
by class, id or role) are left out, and the rest is given back block by block. A name of several words counts only if all of them
speak of such parts or of layout: ``ad-banner`` does, ``has-sidebar`` and ``share-price`` don't. What such a mark means is settled once
the page is read: an element that holds more than half of the page's words is the page's frame whatever it is
called, and a form is one only where its words are few for its fields.

Labelled pages are those whose own markup marks the content with exactly one ``article`` or ``main`` element, at most
``LABELLED`` of them, those first by a hash of the identifier; their counts per kind are added up by Spark and the
``KINDS`` most frequent kinds are used. The mark itself is no feature, so pages without it are read the same way. A kind
that was never seen falls back to its block's tag, then to a fixed prior.

White space inside a block becomes one space, blocks are joined in page order by two line feeds; no length limit applies.
Null and empty pages, and pages without any positive word, give an empty text. Unclosed and stray tags do no harm: an
end tag closes what it matches, if anything. Rows are read one by one; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELLED, KINDS = 1000, 2000
#: Limits of a word's score, what a tag costs at least, and the scores of words of unseen kinds.
MOST, TAG_COST, UNSEEN, HINTED = 3.0, 0.1, 0.5, -2.0

# Element names of the markup language, and words in class, id or role that name other parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
NEVER = frozenset(
    "aside button canvas datalist dialog footer form head iframe label menu nav noscript object script select style svg "
    "template textarea title".split()
)
PARTS = frozenset(
    "ad ads advert advertisement adverts advertising alert banner banners breadcrumb breadcrumbs byline comment comments "
    "complementary consent contentinfo cookie cookies dialog disqus footer login masthead menu modal nav navbar navigation "
    "newsletter notice notification pagination pager popup promo promoted promotion related replies reply respond search "
    "share sharing sidebar skip social sponsor sponsored subscribe tags toolbar widget widgets".split()
)
LAYOUT = frozenset(
    "area bar block bottom box center col column container global group inner item items left link links list middle outer page "
    "primary right row secondary section site top wrap wrapper zone".split()
)
CONTENT = ("article", "main")
#: Words that a field of a form explains at most, and words of a form without much explanation.
PER_FIELD, FEW = 20, 40
FIELDS = frozenset("input select textarea button".split())

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)>""", re.S
)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PIECES = re.compile(r"[a-z]+")

#: One token: its kind, its text (None for a tag), its block, whether it is never content, whether it lies in a mark.
Token = tuple[str, str | None, int, bool, bool]


def hint(attributes: str) -> str | None:
    """The part of a page that class, id or role name, if every word of the name is of such a part or of layout."""
    for m in NAMED.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            said = [w for w in PIECES.findall(name)]
            parts = [w for w in said if w in PARTS]
            if parts and all(w in PARTS or w in LAYOUT for w in said):
                return parts[0]
    return None


class Apart:
    """An element that may be apart from the article, and what it turns out to hold."""

    def __init__(self, name: str, element: str) -> None:
        self.name, self.element, self.words, self.fields = name, element, 0, 0

    def holds(self, all_words: int) -> bool:
        """Whether it's apart indeed."""
        if 2 * self.words > all_words and self.words > FEW:
            return False
        return self.element != "form" or self.words <= FEW + PER_FIELD * self.fields


def tokens(page: str) -> tuple[list[Token], int]:
    """The tokens of a page and how many content marks it has."""
    # Name of a tag, text of a word run, block, elements around that may be apart, block tag, in a mark.
    out: list[tuple[str, str | None, int, tuple[Apart, ...], str, bool]] = []
    # Open elements: name, elements around that may be apart, block tag, in a mark.
    stack: list[tuple[str, tuple[Apart, ...], str, bool]] = [("", (), "body", False)]
    block, marks, at, end, total = 0, 0, 0, len(page), 0

    def text(piece: str) -> None:
        nonlocal total
        piece = html.unescape(piece) if "&" in piece else piece
        if piece:
            _, apart, tag, marked = stack[-1]
            n = words(piece)
            total += n
            for x in apart:
                x.words += n
            out.append(("", piece, block, apart, tag if n else "", marked))

    while at < end:
        m = MARKUP.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if name in BLOCKS:
                block += 1
            _, apart, _, marked = stack[-1]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            out.append((f"</{name}>", None, block, apart, "", marked))
            continue
        if name in BLOCKS:
            block += 1
            # A paragraph ends where another block begins, an item where the next item begins.
            top = stack[-1][0]
            if top == "p" or (top == name and name in ("li", "dt", "dd", "tr", "td", "th", "option")):
                stack.pop()
        elif name == "br":
            text(" ")
        _, apart, tag, marked = stack[-1]
        named = hint(m[3])
        if name in FIELDS:
            for x in apart:
                x.fields += 1
        if name in CONTENT:
            marks += 1
            apart, marked = (), True
        elif name not in ("body", "html") and (name in NEVER or named is not None or (name == "header" and not marked)):
            apart = (*apart, Apart(f"{name}.{named}" if named else name, name))
        if name in BLOCKS:
            tag = name
        out.append((f"<{name}.{named}>" if named else f"<{name}>", None, block, apart, "", marked))
        if name in RAW:
            close = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
        elif name not in VOID and not m[3].endswith("/"):
            stack.append((name, apart, tag, marked))
    known: dict[tuple[Apart, ...], str | None] = {}
    return [settled(t, total, known) for t in out], marks


def settled(token: tuple, total: int, known: dict[tuple[Apart, ...], str | None]) -> Token:
    """The token's kind, once it's known which of the elements around it are apart."""
    tag, piece, block, around, inside, marked = token
    if around not in known:
        held = [x.name for x in around if x.holds(total)]
        known[around] = held[-1] if held else None
    apart = known[around]
    if piece is None:
        kind = tag
    else:
        kind = f"{apart or 'body'}/{inside}" if inside else ""
    return kind, piece, block, apart is not None, marked


def words(piece: str) -> int:
    return len(piece.split())


def kind_counts(pages: list[str | None]) -> Counter:
    """``(kind, inside the mark?)`` → words or tags, of the pages with exactly one mark."""
    out: Counter = Counter()
    for page in pages:
        found, marks = tokens(page or "")
        if marks == 1:
            for kind, piece, _, _, marked in found:
                if kind:
                    out[kind, marked] += words(piece) if piece is not None else 1
                    if piece is not None:
                        out["*" + kind.split("/")[1], marked] += words(piece)
    return out


def weigh(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Log odds of lying inside, per kind; tags cost at least a little."""
    out = {}
    for kind, (inside, outside) in counts.items():
        odds = max(-MOST, min(MOST, math.log((inside + 0.5) / (outside + 0.5))))
        out[kind] = min(odds / MOST, 0.0) - TAG_COST if kind[0] == "<" else odds
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and last + 1 place of the contiguous run with the largest sum, in one scan; (0, 0) if none is positive."""
    best, best_from, best_to, total, begin = 0.0, 0, 0, 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += score
        if total > best:
            best, best_from, best_to = total, begin, i + 1
    return best_from, best_to


def score_of(token: Token, weights: dict[str, float]) -> float:
    kind, piece, _, never, _ = token
    if piece is None:
        return weights.get(kind, -TAG_COST)
    if not kind:
        return 0.0
    score = weights.get(kind)
    if score is None:
        score = HINTED if never else weights.get("*" + kind.split("/")[1], UNSEEN)
    return score * words(piece)


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The main text of one page."""
    found, _ = tokens(page or "")
    best_from, best_to = best_run([score_of(t, weights) for t in found])
    blocks: dict[int, list[str]] = {}
    for _, piece, block, never, _ in found[best_from:best_to]:
        if piece is not None and not never:
            blocks.setdefault(block, []).append(piece)
    joined = (" ".join("".join(b).split()) for b in blocks.values())
    return "\n\n".join(b for b in joined if b)


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> dict[str, float]:
    """Weights from the labelled pages."""
    ids = pages.select(F.col(f"`{id_col}`").alias("_id")).where("_id is not null")
    ids = [r[0] for r in ids.distinct().orderBy(F.xxhash64("_id"), "_id").limit(LABELLED).collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = kind_counts(batch.column(0).to_pylist())
            if sums:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k for k, _ in sums], pa.string()),
                        pa.array([n if inside else 0 for (_, inside), n in sums.items()], pa.int64()),
                        pa.array([0 if inside else n for (_, inside), n in sums.items()], pa.int64()),
                    ],
                    ["kind", "inside", "outside"],
                )

    chosen = pages.where(F.col(f"`{id_col}`").isin(ids)).select(F.col(f"`{html_col}`").alias("_html"))
    counts = chosen.mapInArrow(run, "kind string, inside long, outside long").groupBy("kind")
    counts = counts.agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    rows = counts.orderBy(F.desc(F.col("inside") + F.col("outside")), "kind").limit(KINDS).collect()
    return weigh({r["kind"]: (r["inside"], r["outside"]) for r in rows})


def main_text(
    pages: DataFrame, weights: dict[str, float] | None = None, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``<id>, <url>, text, n_chars`` for every page."""
    known = learn(pages, id_col, html_col) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [extract(p, known) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["_id", "_url", "text", "n_chars"],
                )

    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(*[F.col(f"`{c}`").alias(n) for c, n in ((id_col, "_id"), (url_col, "_url"), (html_col, "_html"))])
    out = rows.mapInArrow(run, f"_id {kind}, _url string, text string, n_chars long")
    return out.withColumnsRenamed({"_id": id_col, "_url": url_col})
