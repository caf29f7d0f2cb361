"""Main text of web pages, by deducing the template of each host.

A page is a sequence of tokens: elements, named by their path of tags and classes, and
pieces of text under a path. Tokens of one host that occur once on the same pages
share an occurrence vector and form an equivalence class. A class is valid by its number
of tokens and of pages, so a site may have several layouts; valid classes keep one order and
are nested, by the stretch of the page that they span, into the host's template. What a
page holds in its slots, between template tokens, remains; slots inside menus, adverts,
comments and the like are left out by the names of their elements, unless such an element
holds the article or frames most of the page, and where the page marks its article only slots
inside it count and nothing inside it is taken for the template.

Occurrence vectors are never gathered. A vector is the exclusive or of one hash for each
page, made by partial aggregates, so a host of any size is spread over all tasks.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.store import per_host, written
from corpusloom.llm.words import blocks

#: A class stands on this share of a host's pages, and on as many pages at least; it has as
#: many tokens at least, or else stands on nearly all pages: a quoted sentence is no template.
SUPPORT, MIN_PAGES, MIN_TOKENS, NEARLY_ALL = 0.15, 5, 2, 0.9

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|template|iframe|svg|math|xmp)\b[^>]*+>"
    r".*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^\"'>]|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z!?/][^>]*+>?",
    re.S | re.I,
)
NAMES = re.compile(r"(?<![-\w:.])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z]+")

#: Elements without content, elements that begin a new block, and what closes what.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body br button caption center dd details dialog dir div dl "
    "dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li "
    "main menu nav ol option p pre search section select summary table tbody td tfoot th thead "
    "tr ul".split()
)
CLOSED_BY_ITSELF = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
#: Elements, and names of elements, that are not part of the article.
ASIDE = set(
    "nav header footer aside form button select menu head dialog search fieldset object "
    "canvas audio video".split()
)
ASIDE_NAMES = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs header masthead footer notice "
    "notices cookie cookies consent gdpr popup modal overlay alert banner newsletter subscribe "
    "subscription signup login search share sharing social related recommended recommendations "
    "teaser comment comments disqus discussion replies reply respond widget pagination pager "
    "toolbar complementary contentinfo".split()
)
#: Words that may stand beside those in one name: site-footer, but not no-sidebar.
PLACES = set(
    "site page top bottom left right main global primary secondary box list area section bar "
    "container wrapper wrap block links link item items inner outer row group module unit slot "
    "buttons button form post article content".split()
)
#: Frames that wrap whole pages at times: left out only if they hold less than most of the text.
FRAMES = set("form fieldset header masthead sidebar banner overlay modal popup widget dialog".split())
#: Left out even if they hold an article: each comment may be marked as one.
READERS = set("comment comments disqus discussion replies reply respond".split())


def words_aside(name: str) -> set[str]:
    """The words for which a whole class name or id says that an element is left out."""
    words = set(WORD.findall(name))
    found = words & ASIDE_NAMES
    return found if found and words - found <= PLACES else set()


class Page:
    """Tokens of a page in order: ``(hash, text, aside, inside article, inside main)``.

    ``text`` is None for an element. Texts between two breaks are one block. The work is
    linear in the page: a closing tag that matches nothing is one step.
    """

    __slots__ = ("tokens",)

    def __init__(self, source: str):
        tokens: list[tuple] = []
        # Tag, path, path of the block around, inside article, inside main, own region.
        stack: list[tuple] = [("", 0, 0, False, False, None)]
        open_tags: Counter = Counter()
        # What may be left out: first token, end, whether it holds an article, by readers, frame.
        regions: list[list] = []
        pending: list[str] = []
        at = 0

        def flush() -> None:
            if pending:
                text = " ".join("".join(pending).split())
                pending.clear()
                if text:
                    _, _, block, article, main, _ = stack[-1]
                    tokens.append((xxhash.xxh64_intdigest(text, block ^ 1), text, article, main))

        def pop() -> None:
            tag, *_, region = stack.pop()
            open_tags[tag] -= 1
            if region is not None:
                flush()
                regions[region][1] = len(tokens)

        for found in MARKUP.finditer(source):
            if found.start() > at:
                pending.append(html.unescape(source[at : found.start()]))
            at = found.end()
            tag = found["tag"]
            if tag is None:
                if found["raw"] and found["raw"].lower() in ("textarea", "title"):
                    flush()
                continue
            tag = tag.lower()
            if tag in BLOCK:
                flush()
            if found["close"]:
                if open_tags[tag]:
                    while True:
                        top = stack[-1][0]
                        if top in BLOCK:
                            flush()
                        pop()
                        if top == tag:
                            break
                continue
            if tag in BLOCK and tag != "br":
                # A new block ends an open paragraph and, in lists and tables, its neighbour.
                while len(stack) > 1 and stack[-1][0] not in BLOCK:
                    pop()
                if stack[-1][0] == "p":
                    pop()
                ends = CLOSED_BY_ITSELF.get(tag, ())
                while stack[-1][0] in ends:
                    pop()
            names = [n for three in NAMES.findall(found["rest"]) for n in "".join(three).lower().split()]
            _, path, block, article, main, _ = stack[-1]
            own = xxhash.xxh64_intdigest(" ".join([tag, *names]), path)
            said = set().union(*map(words_aside, names)) if names else set()
            if tag in ("html", "body", "main") or tag == "article" and not said & READERS:
                said = set()
            beside = tag in ASIDE or bool(said)
            if beside:
                flush()
            elif tag in ("article", "main"):
                for entry in stack:
                    if entry[5] is not None:
                        regions[entry[5]][2] = True
            if tag in BLOCK:
                tokens.append((own, None, article, main))
            if tag not in VOID and not found["rest"].rstrip().endswith("/"):
                if beside:
                    why = said or {tag}
                    regions.append([len(tokens), None, False, bool(why & READERS), why <= FRAMES])
                open_tags[tag] += 1
                stack.append(
                    (
                        tag,
                        own,
                        own if tag in BLOCK else block,
                        article or tag == "article" and not beside,
                        main or tag == "main" or "main" in names,
                        len(regions) - 1 if beside else None,
                    )
                )
        if at < len(source):
            pending.append(html.unescape(source[at:]))
        flush()
        self.tokens = self._judged(tokens, regions)

    @staticmethod
    def _judged(tokens: list[tuple], regions: list[list]) -> list[tuple]:
        """The tokens with whether they are left out.

        A region that holds an article is not, unless readers wrote it, nor a frame that holds
        most of the text.
        """
        before = [0]
        for token in tokens:
            before.append(before[-1] + len(token[1] or ""))
        step = [0] * (len(tokens) + 1)
        for first, end, holds, readers, frame in regions:
            end = len(tokens) if end is None else end
            most = 2 * (before[end] - before[first]) > before[-1]
            if readers or not (holds or frame and most):
                step[first] += 1
                step[end] -= 1
        out, inside = [], 0
        for (key, text, article, main), change in zip(tokens, step, strict=False):
            inside += change
            out.append((key, text, inside > 0, article, main))
        return out

    def texts(self, template: dict[int, int] | None = None) -> list[str]:
        """Texts of the slots: outside the template, inside the article if there is one."""
        fixed = self._fixed(template) if template else frozenset()
        every = [(k, t) for k, t in enumerate(self.tokens) if t[1] is not None]
        own = [(k, t) for k, t in every if not t[2]] or every
        for place in (3, 4):
            inside = [(k, t) for k, t in own if t[place]]
            if inside:
                own = inside
                break
        slots = [t[1] for k, t in own if k not in fixed]
        return slots or [t[1] for _, t in own]

    def _fixed(self, template: dict[int, int]) -> set[int]:
        """Places of tokens of the template, as far as they keep its order.

        That is a longest increasing run of their ranks; a text that equals one of the
        template's elsewhere on the page is not taken for it.
        """
        ends: list[int] = []
        last: list[int] = []
        before: dict[int, int] = {}
        for k, token in enumerate(self.tokens):
            rank = template.get(token[0])
            if rank is None:
                continue
            place = bisect_left(ends, rank)
            if place < len(ends) and ends[place] == rank:
                continue
            if place == len(ends):
                ends.append(rank)
                last.append(k)
            else:
                ends[place], last[place] = rank, k
            before[k] = last[place - 1] if place else -1
        out, k = set(), last[-1] if last else -1
        while k >= 0:
            out.add(k)
            k = before[k]
        return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def host_of(url: Column) -> Column:
    """Host of an address in lower case, without user and port; "" where there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)
    return F.coalesce(F.lower(host), F.lit(""))


def page_tokens(pages: DataFrame, url: str, source: str) -> DataFrame:
    """``(host, token, article, place)``: the tokens that stand once on a page, and token 0.

    Texts inside an article that the page marks are not among them. ``host`` and ``article``
    are hashes, the latter of the page's texts outside the elements left out; ``place`` is where the token stands, in ten-thousandths of the page.
    Token 0 stands for the page itself.
    """
    host = F.xxhash64(host_of(F.col(url)))
    given = pages.select(host.alias("host"), F.col(source).alias("html"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, "html"):
            columns: list[list] = [[], [], [], []]
            for host, text in zip(table["host"].to_pylist(), table["html"].to_pylist(), strict=True):
                page = Page(text or "")
                article = _signed(xxhash.xxh64_intdigest("\n".join(page.texts())))
                count = Counter(token[0] for token in page.tokens)
                once = [
                    (t[0], k)
                    for k, t in enumerate(page.tokens)
                    if count[t[0]] == 1 and not (t[1] and (t[3] or t[4]))
                ]
                columns[0] += [host] * (len(once) + 1)
                columns[1] += [0, *(_signed(token) for token, _ in once)]
                columns[2] += [article] * (len(once) + 1)
                columns[3] += [0, *(10_000 * k // len(page.tokens) for _, k in once)]
            arrays = [pa.array(c, type=pa.int64()) for c in columns]
            yield pa.record_batch(arrays, ["host", "token", "article", "place"])

    return given.mapInArrow(work, "host bigint, token bigint, article bigint, place bigint")


def templates(
    pages: DataFrame, url: str = "url", source: str = "html", support: float = SUPPORT
) -> DataFrame:
    """``(host, template)``: per host, as a hash, the ordered tokens of its valid classes.

    ``template`` is an array of (token, class, pages, place). Pages of one article count
    once. A page counts for a token that stands on it exactly once, so that every token
    has one place in the order. Tokens of one vector are a class; it is valid if it stands
    on ``support`` of the host's articles and ``MIN_PAGES`` of them, and has ``MIN_TOKENS``
    tokens or stands on nearly all. A host has at most (tokens of a page) / ``support`` of
    them, so one host's template is a bounded list.
    """
    single = page_tokens(pages, url, source).groupBy("host", "token", "article").agg(
        F.min("place").alias("place")
    )
    vectors = single.groupBy("host", "token").agg(
        F.count("*").alias("pages"),
        F.bit_xor(F.xxhash64("article")).alias("vector"),
        F.avg("place").alias("place"),
    )
    often, _ = written(vectors.filter(f"pages >= {MIN_PAGES}"), "tokens")
    totals = often.filter("token = 0").select("host", F.col("pages").alias("total"))
    frequent = often.filter("token <> 0").join(totals, "host")
    frequent = frequent.filter(F.col("pages") >= support * F.col("total"))
    row = F.struct("place", "token", F.col("vector").alias("class"), "pages")
    classes = frequent.groupBy("host", "vector", "pages", "total").agg(F.collect_list(row).alias("rows"))
    whole = (F.size("rows") >= MIN_TOKENS) | (F.col("pages") >= NEARLY_ALL * F.col("total"))
    valid = classes.filter(whole).groupBy("host").agg(F.collect_list("rows").alias("classes"))
    return valid.select("host", F.array_sort(F.flatten("classes")).alias("template"))


def nest(template: list) -> list[tuple]:
    """``(class, parent, pages, tokens)`` of a template: a class lies in the smallest class
    of more pages that spans it, or at the top (None)."""
    spans: dict[int, list] = {}
    for row in template:
        spans.setdefault(row["class"], []).append(row)
    known = {
        name: (rows[0]["pages"], rows[0]["place"], rows[-1]["place"], rows)
        for name, rows in spans.items()
    }
    out = []
    for name, (count, low, high, rows) in known.items():
        around = [
            (b - a, other)
            for other, (n, a, b, _) in known.items()
            if other != name and n >= count and a <= low and high <= b and (n, b - a) > (count, high - low)
        ]
        out.append((name, min(around)[1] if around else None, count, [r["token"] for r in rows]))
    return out


def main_text(
    pages: DataFrame,
    url: str = "url",
    source: str = "html",
    column: str = "text",
    support: float = SUPPORT,
) -> DataFrame:
    """``pages`` with the main text of each whole page.

    Character references are decoded; white space inside a block is one space; blocks come
    in page order, joined by line feeds. Null and empty pages and pages without text give
    an empty text. A page that would lose all of its article to the template (all pages of
    its host tell the same) keeps it, and a page all of whose text is left out by names keeps
    that. Hosts with fewer than ``MIN_PAGES`` different articles
    have no template. Two paragraphs that a share of a host's unmarked articles quote together
    are taken for a layout. A page of any length or depth is worked on whole. Every row comes back once, with its other columns; a column of the
    new name is replaced.
    """
    kept = pages.drop(column) if column not in (url, source) else pages
    found = templates(pages, url, source, support).select(
        F.col("host").alias("_host"), F.col("template.token").alias("_template")
    )
    found, salt = per_host(found, F.xxhash64(url))
    same = (F.xxhash64(host_of(F.col(url))) == F.col("_host")) & (salt == F.col("_salt"))
    state = (
        kept.join(found, same, "left")
        .drop("_host", "_salt")
        .withColumn("_main_text", F.lit(None).cast("string"))
    )

    at = state.columns.index("_main_text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks: dict[tuple, dict[int, int]] = {}
        for table in blocks(batches, source):
            texts = []
            for text, template in zip(
                table[source].to_pylist(), table["_template"].to_pylist(), strict=True
            ):
                known = None
                if template:
                    key = tuple(template)
                    if key not in ranks:
                        if len(ranks) > 1000:
                            ranks.clear()
                        ranks[key] = {t & (1 << 64) - 1: k for k, t in enumerate(template)}
                    known = ranks[key]
                texts.append("\n".join(Page(text or "").texts(known)))
            made = pa.array(texts, type=table.schema.field(at).type)
            yield from table.set_column(at, table.schema.field(at), made).to_batches()

    done = state.mapInArrow(work, state.schema)
    return done.select(
        *[F.col(c) for c in kept.columns if c != column], F.col("_main_text").alias(column)
    )
