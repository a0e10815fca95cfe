"""Main text of web pages by consensus host paths.

A page becomes text blocks, each in its containers. A container's path is the chain of generalised tags (`div.post-#`: name,
classes, digits as `#`) from the body down, kept as a hash. Each page scores its containers by the text of the blocks in
them, less the text of links, and votes for all of them. Blocks in doubtful containers, whose names or tags are those of
things around articles (comments, widgets, adverts, forms), have DOUBT of a vote. Spark adds the votes of a host. The chain of
paths with more than half of them leads to the winner: the article or main element in it, or else the outermost container
short of the body that has text of its own, such as a headline. Each page's text is cut from there, without its doubtful
containers, but for those of the chain. A page without the winning path, and pages without a host, choose by their own votes.

What meets a host's winner are a page's blocks and where its containers begin and end, not its markup.
"""

from __future__ import annotations

import html
import re
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nucleispark.llm._carry import map_column
from nucleispark.llm.url_filter import host_and_path

#: What a block in a doubtful container votes.
DOUBT = 0.1
# Fixed names of HTML elements by their role.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe template svg annotation annotation-xml xmp noembed noframes".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mpadded mphantom mfenced menclose mmultiscripts mtable mtr mtd".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dt dd td th tr table tbody thead tfoot ul ol dl figure figcaption caption address hr".split())
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_OUT = frozenset("head nav aside footer button select dialog menu object".split()) | _RAW
# Words in class and id of what stands around articles. Inside of an article the weak ones say little, as in `share-price`, `related-work`
# or `entry-header`: they count alone or with the words of such boxes.
_STRONG = r"nav|navbar|navigation|sidebar|footer|ads?|advert|advertisement|sponsor|sponsored|cookies?|consent|gdpr|comments?|disqus|respond|replies|subscribe|newsletter|signup|login|breadcrumbs?|widget|popup|modal|pagination|pager|toolbar"
_WEAK = r"menu|promo|banner|notice|alert|share|sharing|social|related|recommended|form|copyright"
_BOX = r"posts?|articles?|stories|story|links?|buttons?|bar|box|list|icons?|tools?|items?|content|widget|area|wrap|wrapper|container|block|media|reading|topics|videos|pages|message|fields?|group"
_OUT_NAMES = re.compile(rf"(?:^|[-_\s])(?:{_STRONG}|{_WEAK}|header|masthead)(?:$|[-_\s])")
_STRONG_NAMES = re.compile(rf"(?:^|[-_\s])(?:{_STRONG})(?:$|[-_\s])")
_WEAK_NAMES = re.compile(rf"(?:^|\s)(?:(?:entry|post|article|page|site|content|block|js|wp)[-_]+)?(?:{_WEAK})(?:[-_]+(?:{_BOX}))*(?=\s|$)")
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar toolbar".split())
_ATTRIBUTES = r"""((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s>]*+))?)*+)(?:>|\Z)"""
_TOKEN = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([A-Za-z][^\s/>]*+){_ATTRIBUTES}|<(?:[!?]|/(?=[^A-Za-z]))[^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>]*+)))?""")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"[0-9]+")


class Container(NamedTuple):
    """key: hash of its path, 0 for the body; kind: `article`, `main` or none; its blocks are [begin, end)."""

    key: int
    depth: int
    kind: str
    doubtful: bool
    begin: int
    end: int
    vote: float
    own: float


class _Open:
    """A container while the page is read."""

    __slots__ = ("key", "depth", "kind", "doubtful", "weight", "begin", "vote", "own", "article")

    def __init__(self, outer: _Open | None, name: str, doubtful: bool, begin: int):
        self.key = int.from_bytes(blake2b(outer.key.to_bytes(8, "big", signed=True) + name.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True) if outer else 0
        self.depth = outer.depth + 1 if outer else 0
        self.kind = name.partition(".")[0] if name.partition(".")[0] in ("article", "main") else ""
        self.doubtful, self.begin = doubtful, begin
        self.weight = DOUBT if doubtful or outer and outer.weight < 1 else 1.0
        self.article = bool(self.kind) or outer is not None and outer.article
        self.vote = self.own = 0.0


def _named_out(tag: str, names: str, article: bool) -> bool:
    """Whether class and id are those of things around articles. Headings never are; inside of an article weak words need company."""
    if tag in _HEADINGS or not names.strip():
        return False
    return bool(_STRONG_NAMES.search(names) or _WEAK_NAMES.search(names)) if article else bool(_OUT_NAMES.search(names))


def parse(page: str) -> tuple[list[str], list[Container]]:
    """The text blocks of a page in order, without those in menus, headers, footers and the like, and the containers with blocks.

    Votes are square roots of block lengths, so that many blocks of prose beat one long line, without twice the links' text.
    """
    texts: list[str] = []
    made: list[Container] = []
    stack: list[tuple[str, bool, _Open]] = []  # element, whether all in it is left out, and the container it stands in
    open_: list[_Open] = [_Open(None, "", False, 0)]
    parts: list[str] = []
    links = linked = at = 0
    out = False

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                plain = len(text) - 2 * min(linked, len(text))
                if plain > 0:
                    open_[-1].own += open_[-1].weight * plain**0.5
                texts.append(text)
            parts, linked = [], 0

    def close() -> None:
        c = open_.pop()
        vote = c.vote + c.own
        if open_:
            open_[-1].vote += vote
        if len(texts) > c.begin:
            made.append(Container(c.key, c.depth, c.kind, c.doubtful, c.begin, len(texts), vote, c.own))

    def pop(to: int) -> None:
        nonlocal out, links
        for tag, _, inside in reversed(stack[to:]):
            links -= tag == "a"
            places[tag].pop()
            if tag not in _INLINE:
                blocks.pop()
            while open_[-1] is not inside:
                close()
        del stack[to:]
        out = bool(stack) and stack[-1][1]

    # Where in the stack each element and any block is open, so that end tags cost no search.
    places: dict[str, list[int]] = {}
    blocks: list[int] = []
    while True:
        m = _TOKEN.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text and not out:
            parts.append(text)
            linked += len(text) if links else 0
        if m is None:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in _VOID and tag not in _INLINE:
            flush()
            continue
        if tag in ("br", "img"):
            if not out:
                parts.append(" ")
            continue
        if m[1]:
            if tag in _RAW:
                continue
            if places.get(tag):
                to = places[tag][-1]
                if tag not in _INLINE:
                    flush()
                elif blocks and blocks[-1] > to:
                    continue  # a stray end of an inline element closes no block
                pop(to)
            continue
        if tag in _RAW:
            end = _raw_end(tag).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in _INLINE:
            places.setdefault(tag, []).append(len(stack))
            stack.append((tag, out, open_[-1]))
            links += tag == "a"
            continue
        flush()
        shut = _CLOSES_SAME.get(tag) or ({"p"} if tag in _CLOSES_P else None)
        if shut and any(places.get(t) for t in shut):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in shut:
                    pop(i)
                    break
                if stack[i][0] not in _INLINE and stack[i][0] not in ("td", "th", "p") or stack[i][0] in ("td", "th") and tag not in ("td", "th", "tr"):
                    break
        attributes: dict[str, str] = {}
        for k, a, b, c in _ATTRIBUTE.findall(m[3]) if m[3].strip() else ():
            attributes.setdefault(k.lower(), html.unescape(a or b or c))
        names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
        gone = tag in _OUT or tag == "header" and not open_[-1].article or "hidden" in attributes or attributes.get("role", "").lower() in _OUT_ROLES
        doubtful = tag == "form" or tag not in ("html", "body", "article", "main") and _named_out(tag, names, open_[-1].article)
        places.setdefault(tag, []).append(len(stack))
        blocks.append(len(stack))
        stack.append((tag, out or gone, open_[-1]))
        out = out or gone
        if (tag not in _LEAVES or doubtful) and tag not in ("html", "body"):
            open_.append(_Open(open_[-1], ".".join([tag, *sorted(set(_DIGITS.sub("#", attributes.get("class", "").lower()).split()))]), doubtful, len(texts)))
    flush()
    while open_:
        close()
    return texts, made


_raw_ends: dict[str, re.Pattern[str]] = {}


def _raw_end(tag: str) -> re.Pattern[str]:
    if tag not in _raw_ends:
        _raw_ends[tag] = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I)
    return _raw_ends[tag]


def choose(chain: list[tuple[int, int, str, float]]) -> int:
    """The winner's key among the paths (depth, key, kind, own votes) with more than half of the votes, each inside the one before."""
    chain = sorted(chain)
    for name in ("article", "main"):
        named = [key for _, key, kind, _ in chain if kind == name]
        if named:
            return named[-1]
    return next((key for depth, key, _, own in chain if depth and own > 0), chain[-1][1])


def select(texts: list[str], keys: np.ndarray, begins: np.ndarray, ends: np.ndarray, doubtful: np.ndarray, winner: int, kept: list[int]) -> str:
    """The blocks in containers called `winner`, without those in doubtful ones other than `kept`, joined by empty lines."""
    steps = np.zeros((2, len(texts) + 1), np.int64)
    for i, mine in enumerate((keys == winner, doubtful & ~np.isin(keys, kept))):
        np.add.at(steps[i], begins[mine], 1)
        np.add.at(steps[i], ends[mine], -1)
    inside, dropped = np.cumsum(steps, axis=1)[:, :-1] > 0
    return "\n\n".join(texts[i] for i in np.flatnonzero(inside & ~dropped))


def _own(made: list[Container]) -> tuple[int, list[int]]:
    """A page's own winner and the doubtful containers of its chain."""
    total: dict[int, list] = {}
    for c in made:
        x = total.setdefault(c.key, [0.0, 0.0, c])
        x[0] += c.vote
        x[1] += c.own
    most = total[0][0] if 0 in total else 0.0
    chain = [(c.depth, c.key, c.kind, own) for vote, own, c in total.values() if 2 * vote > most] or [(0, 0, "", 0.0)]
    return choose(chain), [c.key for vote, _, c in total.values() if c.doubtful and 2 * vote > most]


def main_text(page: str) -> str:
    """The main text by the page's own votes."""
    texts, made = parse(page)
    return select(texts, *_arrays(made), *_own(made)) if texts else ""


def _arrays(made: list[Container]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.array([c[i] for c in made], kind) for i, kind in ((0, np.int64), (4, np.int64), (5, np.int64), (3, bool)))


_CONTAINERS = pa.list_(pa.struct([("key", pa.int64()), ("depth", pa.int32()), ("kind", pa.string()), ("doubtful", pa.bool_()), ("begin", pa.int32()), ("end", pa.int32()), ("vote", pa.float64()), ("own", pa.float64())]))


def parsed(pages: DataFrame, *, id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(id, url, host, texts, containers, winner, kept) of all pages; winner and kept: the page's own."""
    host, _ = host_and_path(F.col("url"))
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), F.col(page).alias("html")).select("id", "url", host.alias("host"), "html")

    def run(x: pa.Array) -> list[pa.Array]:
        found = [parse(t or "") for t in x.to_pylist()]
        own = [_own(made) for _, made in found]
        return [
            pa.array([t for t, _ in found], pa.list_(pa.string())), pa.array([[c._asdict() for c in made] for _, made in found], _CONTAINERS),
            pa.array([w for w, _ in own], pa.int64()), pa.array([k for _, k in own], pa.list_(pa.int64())),
        ]

    ddl = "texts array<string>, containers array<struct<key:bigint,depth:int,kind:string,doubtful:boolean,begin:int,end:int,vote:double,own:double>>, winner bigint, kept array<bigint>"
    return map_column(rows, "html", ["id", "url", "host"], ddl, run)


def consensus(read: DataFrame) -> DataFrame:
    """(host, host_winner, host_kept) of the parsed pages of each host with votes: the path that its votes lead to, and the doubtful
    ones of the chain."""
    votes = read.filter("host <> ''").select("host", F.inline("containers"))
    total = votes.groupBy("host", "key").agg(F.first("depth").alias("depth"), F.first("kind").alias("kind"), F.first("doubtful").alias("doubtful"), F.round(F.sum("vote"), 3).alias("votes"), F.sum("own").alias("own"))
    # The body's path has all votes of a host. Two paths with more than half of them have a block in common, so one holds the other.
    most = F.max("votes").over(Window.partitionBy("host"))
    chains = total.withColumn("most", most).filter("2 * votes > most").groupBy("host").agg(F.collect_list(F.struct("depth", "key", "kind", "own", "doubtful")).alias("chain"))

    def run(x: pa.Array) -> list[pa.Array]:
        lists = x.to_pylist()
        return [pa.array([choose([(c["depth"], c["key"], c["kind"], c["own"]) for c in chain]) for chain in lists], pa.int64()), pa.array([[c["key"] for c in chain if c["doubtful"]] for chain in lists], pa.list_(pa.int64()))]

    return map_column(chains, "chain", ["host"], "host_winner bigint, host_kept array<bigint>", run)


def extract(pages: DataFrame, *, id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per row: id, url, text (blocks joined by two line feeds; empty if there is none), n_chars.

    Null and empty pages have an empty text. Pages with a null or malformed url use their own votes. Repeated rows stay; copies
    of a page vote each. Pages cut off amid a tag or comment lose that tag. Other columns are not looked at. A host's pages meet
    its winner in a join that Spark may split.
    """
    read = parsed(pages, id=id, url=url, page=page)  # by both branches: kept on disk it would take as much room as the shuffle
    joined = read.join(consensus(read), "host", "left").select("id", "url", F.struct("texts", "containers", "winner", "kept", "host_winner", "host_kept").alias("x"))

    def run(x: pa.Array) -> list[pa.Array]:
        out = []
        lists, flat = x.field("containers"), x.field("containers").flatten()
        at = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
        keys, begins, ends, doubtful = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 4, 5, 3))
        rest = [x.field(n).to_pylist() for n in ("texts", "winner", "kept", "host_winner", "host_kept")]
        for i, (texts, winner, kept, host_winner, host_kept) in enumerate(zip(*rest, strict=True)):
            mine = slice(at[i], at[i + 1])
            arrays = keys[mine], begins[mine], ends[mine], doubtful[mine].astype(bool)
            text = select(texts, *arrays, host_winner, host_kept or []) if texts and host_winner is not None else ""
            out.append(text or (select(texts, *arrays, winner, kept) if texts else ""))
        return [pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())]

    return map_column(joined, "x", ["id", "url"], "text string, n_chars long", run).toDF(id, url, "text", "n_chars")
