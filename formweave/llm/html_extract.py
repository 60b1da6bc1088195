"""Main text of web pages by consensus host paths.

Pages of a host are made from few templates, so its pages agree on where the article stands. Each page scores its
containers and votes for all of them by their generalised path (tags with their first class, digits masked; a path is
a 64-bit hash over its steps); the votes are summed per host, and every page of the host is extracted again below the
path that won, or below the article around it. A page whose own best path is that of at least a quarter of the host's
pages, but which has little text at the winning path, is of another template and keeps its own path. Where a page has
nothing below the winning path, or no url, its own best container stands in.

Names of classes and ids decide little: inside an article a box is left out by its name only if all words of the name
are those of a menu, advert, notice or the like, and inline elements never are. Parsing takes time and memory in
proportion to the page, however deep or broken its markup.

Votes are combined before the shuffle, a row per host and path; the winners are one row per host.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.llm.blocks import materialise, ship, slices
from formweave.llm.url_rules import host_of

# Elements by their role in a page.
DROPPED = frozenset("""head title script style noscript template nav aside footer form button select option textarea
input label fieldset dialog iframe object embed svg canvas audio video map menu""".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("""html body main article section div td th center header hgroup table tbody thead tfoot tr
ul ol dl details figure blockquote address""".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre figcaption caption summary hr".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
                              "form".split())
BOILERPLATE_NAMES = frozenset("""ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox
banner banners sponsor sponsored sponsors promo promos promotion promoted cookie cookies consent gdpr ccpa notice notices
alert alerts popup popups modal overlay lightbox nav navbar navigation navi menu menus submenu sidebar sidebars aside rail
footer footers header headers masthead topbar toolbar breadcrumb breadcrumbs crumbs pager pagination paging comment
comments commentlist respond disqus replies share sharing shares social related recommended recommendations newsletter
subscribe subscription signup login search searchform form widget widgets skip copyright legal tags tagcloud outbrain
taboola""".split())
ARTICLE_NAMES = frozenset("article entry post content story main body page text".split())
WHOLE_NAMES = frozenset("article entry post story".split())  # names of a whole article, heading and lead included
PLAIN_NAMES = frozenset("""left right top bottom box wrapper wrap container list section block area item items inner outer
posts post links link bar panel row col column content""".split())  # say nothing on their own
# Names that a part of an article may well have, heading and footnotes for instance.
IN_ARTICLES = frozenset("header headers form legal tags skip search copyright".split())
INLINE_DROPPED = frozenset("""button label input select option svg map object iframe audio video canvas embed script style
noscript template textarea""".split())
BLOCKS = CONTAINERS | TEXT_BLOCKS | DROPPED - INLINE_DROPPED
CLOSES_P = BLOCKS
STOPS = frozenset(("ul", "ol", "dl", "table", "select"))
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",)}

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[/!?A-Za-z][^>]*>?""",
                   re.S)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
WORD = re.compile(r"[A-Za-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Page:
    """Text blocks of a page, and its containers as (key of the path, last step, parent)."""

    keys: list[int] = field(default_factory=lambda: [0])
    steps: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [-1])
    texts: list[str] = field(default_factory=list)
    homes: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)


def step_key(parent: int, step: str) -> int:
    """Key of a path: a hash of the key of all but its last step, and that step."""
    made = hashlib.blake2b(parent.to_bytes(8, "big", signed=True) + step.encode("utf-8", "surrogatepass"), digest_size=8)
    return int.from_bytes(made.digest(), "big", signed=True)


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def is_boilerplate(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    if tag in DROPPED:
        return True
    if tag in ("html", "body", "main", "article"):
        return False
    if tag == "header":
        return not in_article
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or HIDDEN.search(attrs.get("style", "")):
        return True
    if attrs.get("role", "").lower() in BOILERPLATE_ROLES:
        return True
    return tag in BLOCKS and any(map(
        is_aside if in_article or tag in TEXT_BLOCKS else may_be_aside,
        (attrs.get("class", "") + " " + attrs.get("id", "")).split()))


def words_of(name: str) -> list[str]:
    return [p.lower() for p in WORD.findall(CAMEL.sub("-", name))]


def is_aside(name: str) -> bool:
    """Whether a class or id names nothing but a menu, advert, notice or the like."""
    words = set(words_of(name))
    named = words & BOILERPLATE_NAMES
    return bool(named - IN_ARTICLES) and words <= named | PLAIN_NAMES


def may_be_aside(name: str) -> bool:
    """Whether a class or id begins or ends with such a name."""
    words = words_of(name)
    if not words or words[0] in ("has", "with", "no", "without", "is"):
        return False
    named = BOILERPLATE_NAMES.intersection((words[0], words[-1]))
    return bool(named) and not (named <= {"header", "headers", "tags", "form"} and ARTICLE_NAMES.intersection(words))


def is_whole(tag: str, step: str) -> bool:
    """Whether a container is an article by its tag or name."""
    return tag in ("article", "main") or (tag not in ("html", "body") and not WHOLE_NAMES.isdisjoint(
        WORD.findall(step.partition(".")[2])))


def label(tag: str, attrs: dict[str, str]) -> str:
    """A container's step in a path: its tag and first class, digits masked."""
    names = attrs.get("class", "").split() or attrs.get("id", "").split()
    return tag + ("." + re.sub(r"\d+", "0", names[0].lower()) if names else "")


def parse(source: str) -> Page:
    """One pass over the markup. Unclosed and misnested elements end with the element around them."""
    page = Page()
    open_tags: list[tuple[str, int, bool]] = [("", 0, False)]  # tag, container, whether it is an article
    depths: dict[str, list[int]] = {}  # of the open elements of each tag
    containers: list[int] = [0]  # depths of the open containers
    skip_from = 0  # depth of the outermost dropped element, 0 if none is open
    in_article = in_link = 0
    held: list[str] = []
    held_links = 0

    def end_block() -> None:
        nonlocal held_links
        if held:
            text = " ".join("".join(held).split())
            if text:
                page.texts.append(text)
                page.homes.append(open_tags[-1][1])
                page.linked.append(held_links)
            held.clear()
        held_links = 0

    def add(raw: str) -> None:
        nonlocal held_links
        if raw and not skip_from:
            if "&" in raw:
                raw = html.unescape(raw)
            held.append(raw)
            if in_link:
                held_links += len(raw)

    def close(depth: int) -> None:
        """Close all elements from this depth on."""
        nonlocal skip_from, in_article, in_link
        while len(open_tags) > depth:
            tag, _, whole = open_tags[-1]
            if tag in BLOCKS and not skip_from:
                end_block()
            in_article -= whole
            in_link -= tag == "a"
            open_tags.pop()
            depths[tag].pop()
            if tag in CONTAINERS:
                containers.pop()
            if skip_from and len(open_tags) <= skip_from:
                skip_from = 0

    def nearest(tags: Iterable[str]) -> int:
        return max((depths[t][-1] for t in tags if depths.get(t)), default=0)

    def close_nearest(tags: tuple[str, ...], stop: int) -> None:
        """Close the nearest open element of these tags, if it is inside the one at depth ``stop``."""
        depth = nearest(tags)
        if depth > stop:
            close(depth)

    position, size = 0, len(source)
    while position < size:
        found = TOKEN.search(source, position)
        if not found:
            add(source[position:])
            break
        add(source[position: found.start()])
        position = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag == "br":
                add(" ")
            elif tag not in VOID:
                close_nearest((tag,), 0 if tag in CONTAINERS or tag in DROPPED else containers[-1])
            continue
        if tag in CLOSES_P:
            close_nearest(("p",), containers[-1])
        if tag in SIBLINGS:
            close_nearest(SIBLINGS[tag], nearest(STOPS))
        if tag in VOID:
            if tag == "br":
                add(" ")
            elif tag == "hr" and not skip_from:
                end_block()
            continue
        if found[3].endswith("/") and tag not in CONTAINERS and tag not in TEXT_BLOCKS and tag not in RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(source, position)
            if tag not in DROPPED and not skip_from:
                add(source[position: end.start() if end else size])
            position = end.end() if end else size
            continue
        attrs = attributes(found[3]) if found[3] and not skip_from else {}
        home = open_tags[-1][1]
        whole = False
        if tag in BLOCKS and not skip_from:
            end_block()
        if not skip_from and is_boilerplate(tag, attrs, in_article > 0):
            skip_from = len(open_tags)
        elif not skip_from and tag in CONTAINERS:
            step = label(tag, attrs)
            whole = is_whole(tag, step)
            page.keys.append(step_key(page.keys[home], step))
            page.steps.append(step)
            page.parents.append(home)
            home = len(page.keys) - 1
        in_article += whole
        in_link += tag == "a"
        depths.setdefault(tag, []).append(len(open_tags))
        if tag in CONTAINERS:
            containers.append(len(open_tags))
        open_tags.append((tag, home, whole))
    if not skip_from:
        end_block()
    return page


def articles(page: Page) -> list[int]:
    """The article each container belongs to, itself included, -1 if none: the nearest article or main element, or
    else the outermost container with the name of one."""
    out = [-1] * len(page.keys)
    for i, (step, parent) in enumerate(zip(page.steps, page.parents)):
        if parent < 0:
            continue
        tag = step.partition(".")[0]
        if tag in ("article", "main"):
            out[i] = i
        elif out[parent] >= 0:
            out[i] = out[parent]
        elif is_whole(tag, step):
            out[i] = i
    return out


def scores(page: Page) -> dict[int, float]:
    """Score of each container path: the text that stands in it directly, less what is links, all that its children
    hold up to the article around them, and a half, a quarter and an eighth of it in the three containers above.
    Articles and main elements count more, lists and tables less."""
    tops = articles(page)
    held = [[0.0] * 4 for _ in page.keys]  # text that counts whole, a half, a quarter, an eighth
    for text, home, linked in zip(page.texts, page.homes, page.linked):
        held[home][0] += max(0.0, len(text) - 2.0 * linked) + 1.0
    out: dict[int, float] = {}
    for i in range(len(page.keys) - 1, -1, -1):  # children come after their parents
        whole, half, quarter, eighth = held[i]
        value = whole + half / 2 + quarter / 4 + eighth / 8
        if page.parents[i] > 0:
            above = held[page.parents[i]]
            above[0 if 0 <= tops[i] < i else 1] += whole
            above[2] += half
            above[3] += quarter
        if value:
            tag, _, name = page.steps[i].partition(".")
            factor = 2.0 if tag in ("article", "main") else 0.5 if tag in (
                "ul", "ol", "dl", "table", "tbody", "tr", "td", "html") else 1.0
            if ARTICLE_NAMES.intersection(WORD.findall(name)):
                factor *= 1.5
            out[page.keys[i]] = out.get(page.keys[i], 0.0) + value * factor
    return out


def best(page: Page) -> int | None:
    found = scores(page)
    return max(found, key=lambda p: (found[p], p)) if found else None


def extract(page: Page, path: int | None) -> str:
    """Blocks of the containers with this path, or of the articles they belong to, and of all containers inside them,
    in page order."""
    tops = articles(page)
    chosen = {i if top < 0 else top for i, (own, top) in enumerate(zip(page.keys, tops)) if own == path}
    inside = [False] * len(page.keys)
    for i, parent in enumerate(page.parents):
        inside[i] = i in chosen or (parent >= 0 and inside[parent])
    return "\n".join(t for t, home in zip(page.texts, page.homes) if inside[home])


def main_text(source: str, path: int | None, others: Iterable[int]) -> str:
    """Text of a page of a host with the winning ``path`` and the paths of its ``others`` templates."""
    page = parse(source)
    found = scores(page)
    own = best(page)
    if path is None or (own in others and found.get(path, 0.0) < found[own] / 2):
        path = own
    return extract(page, path) or extract(page, own)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        votes: dict[tuple[str, int], list[float]] = {}
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = scores(parse(source))
            top = max(found, key=lambda p: (found[p], p), default=None)
            for path, score in found.items():
                entry = votes.setdefault((host, path), [0.0, 0])
                entry[0] += score / found[top]
                entry[1] += path == top
        # Whole numbers add up alike in any order.
        yield pa.record_batch([pa.array([h for h, _ in votes], pa.string()), pa.array([p for _, p in votes], pa.int64()),
                               pa.array([round(v * 1e6) for v, _ in votes.values()], pa.int64()),
                               pa.array([n for _, n in votes.values()], pa.int64())],
                              names=["host", "path", "votes", "pages"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [main_text(source, path, others or ()) if source else ""
                 for source, path, others in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                              names=["page_id", "url", "text"])


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path, others: the container path with the most votes of each host (ties go to the greatest key), and the
    paths that are the best of at least a quarter of its pages, at most four. Pages without a host have no vote."""
    ship(pages.sparkSession)
    rows = pages.select(host_of("url").alias("host"), "html").where("html IS NOT NULL AND host != ''")
    votes = rows.mapInArrow(_votes, "host string, path bigint, votes bigint, pages bigint").groupBy("host", "path").agg(
        F.sum("votes").alias("votes"), F.sum("pages").alias("pages"))
    votes = materialise(votes, "host-votes")
    tops = votes.groupBy("host").agg(F.max(F.struct("votes", "path")).alias("top"), F.sum("pages").alias("all"))
    often = votes.where("pages > 0").select(F.col("host").alias("of"), F.col("path").alias("other"), "pages")
    joined = tops.join(often, (F.col("host") == F.col("of")) & (F.col("pages") * 4 >= F.col("all")), "left")
    return joined.groupBy("host", "top.path").agg(F.array_sort(F.collect_list("other")).alias("others"))


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of ``pages``. A null or empty page has an empty text; pages without
    a url, or with one without a host, go by their own best container. Repeated pages vote each and get the same text;
    a tie of two paths goes to the greater key. A page is held whole by one task, whatever its length."""
    winners = materialise(host_paths(pages), "host-paths").withColumnRenamed("host", "of_host")
    rows = pages.select("page_id", "url", "html").withColumn("host", host_of("url"))
    rows = rows.join(winners, F.col("host") == F.col("of_host"), "left").select("page_id", "url", "html", "path", "others")
    kinds = dict(rows.dtypes)
    out = rows.mapInArrow(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
