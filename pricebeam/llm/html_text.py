"""Main text of web pages, with the container paths that a host's pages agree on."""

from __future__ import annotations

import html as html_entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricebeam.llm.blocks import PAYLOAD, TEXT, packed
from pricebeam.session import materialize

#: A tag's attributes: a quote opens a string only at the start of a value.
ATTRIBUTES = r"(?:=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+)?+|[^>=]++)*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<svg(?=[\s/])" + ATTRIBUTES + r"(?<=/)>"
    r"|<(script|style|noscript|template|iframe|svg|textarea|select)(?=[\s/>])" + ATTRIBUTES + r">.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)(" + ATTRIBUTES + r")>|<[!?][^>]*>", re.DOTALL | re.IGNORECASE)
ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*))?)?")
NAMING = frozenset(("class", "id", "role", "hidden"))
#: A slash that ends an unquoted value, not the tag.
VALUE_SLASH = re.compile(r"=\s*[^\s\"'>][^\s>]*/\Z")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var br img wbr".split())
#: Elements that never hold article text.
DROPPED = frozenset("head title nav header footer aside form button dialog menu script style noscript template "
                    "iframe svg textarea select object canvas audio video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What becomes of an element's text: kept, judged by its links, dropped, or dropped but for headings.
KEPT, DOUBTFUL, GONE, TITLED = range(4)
#: Words of a class, id or role that name something beside the article.
ASIDE = frozenset("ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie "
                  "cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter overlay "
                  "pagination pager popup replies respond sidebar signup sponsor sponsored subscribe toolbar "
                  "widget widgets".split())
#: Words that do so unless the article is named, too.
BESIDE = frozenset("disclaimer form header notice notices notification promo promoted promotion related reply share "
                   "sharing skip social".split())
#: Those of them that paragraphs and quotes of an article bear, too; there links decide.
QUOTED = frozenset("related reply share sharing skip social".split())
#: Words that say what an element has, not what it is.
HAS = frozenset("has with no without".split())
#: Words of those that name the article.
MAIN = frozenset("article body content entry main maincontent post story text".split())
#: Elements that a start tag closes if they are open.
CLOSES = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
CLOSES_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                     "main nav ol p pre section table ul".split())
#: Closing tags do not reach beyond these.
FENCES = frozenset("table td th article section div body html".split())
SECTIONS = frozenset("article main section div td body".split())


def _names(attributes: str) -> tuple[str, int, bool]:
    """The generalised class (or id) of an element, whether it names something beside the article (GONE, or
    DOUBTFUL if only by words that parts of an article bear, too), and whether it names the article."""
    label, words, hidden = "", set(), False
    for m in ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind not in NAMING:
            continue
        if kind == "hidden":
            hidden = True
            continue
        words.update(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
        if kind == "class" or kind == "id" and not label:
            label = ".".join(sorted(re.sub(r"\d+", "#", value).lower().split()))
    main = bool(words & MAIN)
    found = set() if words & HAS else words & ASIDE or (words & BESIDE if not main else set())
    beside = GONE if hidden or found - QUOTED else DOUBTFUL if found else KEPT
    return label, beside, main


def _fate(tag: str, around: int, beside: int, named: bool, in_article: bool) -> int:
    """What becomes of an element's text, from what becomes of the one around it. Captions, the headings of a
    header, and paragraphs and quotes that a doubtful word names belong to an article if they stand in one."""
    if around == GONE or tag in DROPPED and tag != "header":
        return GONE
    if tag in ("html", "body", "main") or tag == "article" and named:
        beside = KEPT
    if beside == DOUBTFUL and not (in_article and tag in ("p", "blockquote")):
        beside = GONE
    if tag == "header":
        return TITLED if in_article else GONE
    if beside == GONE or tag == "figcaption" and not in_article:
        return GONE
    if around == TITLED:
        return KEPT if tag in HEADINGS else TITLED
    return max(around, beside)


def blocks_of(page: str) -> list[tuple[tuple[str, ...], bool, str, int]]:
    """Text blocks in page order: the generalised tag-class path of the enclosing element, whether its
    text is dropped, the text, and how many of its characters are links.

    The path counts elements of a kind alike (div.post-12 is div.post-#), so that it names the same
    place on all pages of a host. Markup need not be well formed. Attributes are read by the rules of HTML: an
    apostrophe or slash inside an unquoted value is part of it, and only the name of an element says that it
    has no end."""
    out: list[tuple[tuple[str, ...], bool, str, int]] = []
    stack: list[tuple[str, str, bool]] = []  # tag, path step, and for inline elements whether they are left out
    fates: list[int] = []  # of the elements in the stack that are not inline
    parts: list[str] = []
    linked = links = mute = articles = 0

    def close_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html_entities.unescape("".join(parts)).split())
            if text:
                fate = fates[-1] if fates else KEPT
                gone = fate in (GONE, TITLED) or fate == DOUBTFUL and 3 * linked >= len(text)
                out.append((tuple(step for tag, step, _ in stack if tag not in INLINE), gone, text,
                            min(linked, len(text))))
            parts.clear()
        linked = 0

    def pop(count: int) -> None:
        nonlocal links, mute, articles
        for _ in range(count):
            tag, _, left_out = stack.pop()
            links -= tag == "a"
            if tag in INLINE:
                mute -= left_out
            else:
                articles -= fates.pop() != GONE and tag in ("article", "main")

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at and not mute:
            piece = page[at : m.start()]
            parts.append(piece)
            if links:
                linked += len(piece)
        at = m.end()
        name = m[3]
        if name is None:
            continue
        tag = name.lower()
        if tag in INLINE:
            if tag in VOID:
                if tag == "br":
                    parts.append(" ")
            elif m[2]:
                for up, (t, _, _) in enumerate(reversed(stack), 1):
                    if t == tag:
                        pop(up)
                        break
                    if t not in INLINE:
                        break
            elif not m[4].endswith("/") or VALUE_SLASH.search(m[4]):
                # A dropped inline element is left out of its block; inside dropped blocks all is dropped.
                left_out = bool(mute) or bool(m[4]) and _names(m[4])[1] != KEPT
                stack.append((tag, tag, left_out))
                mute += left_out
                links += tag == "a"
            continue
        close_block()
        if m[2]:
            for up, (t, _, _) in enumerate(reversed(stack), 1):
                if t == tag:
                    pop(up)
                    break
                if t in FENCES and tag not in FENCES:
                    break
            continue
        if tag in VOID:
            continue
        closing = CLOSES.get(tag, ()) + (("p",) if tag in CLOSES_P else ())
        for up, (t, _, _) in enumerate(reversed(stack), 1):
            if t in closing:
                pop(up)
                break
            if t not in INLINE:
                break
        label, beside, named = _names(m[4]) if m[4] else ("", KEPT, False)
        fate = GONE if mute else _fate(tag, fates[-1] if fates else KEPT, beside, named, articles > 0)
        stack.append((tag, f"{tag}.{label}" if label else tag, False))
        fates.append(fate)
        articles += fate != GONE and tag in ("article", "main")
    if at < len(page) and not mute:
        parts.append(page[at:])
    close_block()
    return out


def container_scores(blocks: list[tuple[tuple[str, ...], bool, str, int]]) -> dict[str, float]:
    """A score for each section-like path: its text that is not links, most for the nearest sections,
    since an outer section holds the article and more."""
    scores: dict[str, float] = {}
    for path, dropped, text, linked in blocks:
        if dropped:
            continue
        worth = len(text) - 2 * linked
        worth = worth if len(text) >= 25 else 0.2 * worth
        weight = 1.0
        for i in range(len(path), 0, -1):
            tag = path[i - 1].partition(".")[0]
            if tag in SECTIONS:
                bonus = 1.3 if tag in ("article", "main") else 1.0
                key = "/".join(path[:i])
                scores[key] = scores.get(key, 0.0) + weight * bonus * worth
                weight *= 0.6
    return scores


def climbed(blocks: list[tuple[tuple[str, ...], bool, str, int]], container: str) -> str:
    """The outermost section around `container` that adds only text with few links to it, step by step: a
    title, a lead or further parts of the article beside its largest part. Sections that lie side by side
    in the body itself are different things, so the body adds only what is in none of them."""
    steps = tuple(container.split("/"))
    best = size = len(steps)
    kept = [(path, len(text), linked) for path, dropped, text, linked in blocks if not dropped]
    for i in range(size - 1, 0, -1):
        tag = steps[i - 1].partition(".")[0]
        if tag not in SECTIONS:
            continue
        extra = [x for x in kept if x[0][:i] == steps[:i] and x[0][:best] != steps[:best]]
        if 3 * sum(x[2] for x in extra) > sum(x[1] for x in extra):
            break
        if tag == "body" and any(step.partition(".")[0] in SECTIONS for x in extra for step in x[0][i:]):
            break
        if extra:
            best = i
    return "/".join(steps[:best])


def _best(blocks: list[tuple[tuple[str, ...], bool, str, int]]) -> tuple[str, float] | None:
    scores = container_scores(blocks)
    if not scores:
        return None
    path, score = max(scores.items(), key=lambda x: (x[1], x[0]))
    return climbed(blocks, path), score


def best_container(page: str) -> tuple[str, float] | None:
    return _best(blocks_of(page))


def main_text(page: str | None, wanted: str | None = None) -> str:
    """Text of the container at path `wanted`, or of the page's best one if the page lacks that path, and of
    the sections around it that belong to it."""
    blocks = blocks_of(page or "")

    def within(container: str) -> list[str]:
        steps = tuple(container.split("/"))
        return [text for path, dropped, text, _ in blocks if not dropped and path[: len(steps)] == steps]

    found = within(wanted) and within(climbed(blocks, wanted)) if wanted else []
    if not found:
        best = _best(blocks)
        found = within(best[0]) if best else [text for _, dropped, text, _ in blocks if not dropped]
    return "\n\n".join(found)


def host_of(url: Column) -> Column:
    """The host of a URL, lower case; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path, votes, pages): the path that most of the host's pages score best."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [best_container(x) if x else None for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x and x[0] for x in best], pa.string()),
                 pa.array([x and x[1] for x in best], pa.float64())], names=["host", "path", "score"])

    votes = (pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`").cast("string").alias("html"))
             .mapInArrow(work, "host string, path string, score double").filter("path IS NOT NULL")
             .groupBy("host", "path").agg(F.count("*").alias("votes")))
    ranked = votes.groupBy("host").agg(F.sum("votes").alias("pages"),
                                       F.max(F.struct("votes", "path")).alias("best"))
    return ranked.select("host", F.col("best.path").alias("path"), F.col("best.votes").alias("votes"), "pages")


def extract_text(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The columns of `pages`, text and n_chars (code points).

    Two passes: each page votes for the path of its best container, with the sections around it that add
    only text with few links; then every page is cut again, in the same way, along the path that won at its host, if at least half of the host's pages chose it; pages without that
    path, and hosts without agreement, use the page's own best container. Blocks are joined in page
    order by an empty line. Null and empty pages have an empty text. The host of a null or odd url is
    empty. Rows are not told apart by any column; new columns replace those of the same names.
    """
    winners = materialize(host_paths(pages, url, html).filter("2 * votes >= pages").select("host", "path"), "paths")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x, path) if x else ""
                     for x, path in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64())], names=[TEXT, PAYLOAD, "main", "n_chars"])

    thin = (packed(pages, html).withColumn("host", host_of(F.col(PAYLOAD)[url]))
            .join(winners, "host", "left").select(TEXT, PAYLOAD, "path"))
    schema = T.StructType([*thin.schema.fields[:2], T.StructField("main", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    result = thin.mapInArrow(work, schema)
    kept = [c for c in pages.columns if c not in ("text", "n_chars")]
    return result.select(*[F.col(TEXT).alias(c) if c == html else F.col(PAYLOAD)[c].alias(c) for c in kept],
                         F.col("main").alias("text"), "n_chars")
