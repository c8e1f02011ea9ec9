"""Main text of web pages by wrappers inferred for each host.

A wrapper is a regular expression without unions over the host's token streams: a
sequence of elements, each maybe optional or repeated, with slots for text.  It is
inferred by aligning the streams of a host's pages one after the other: what only one
side has becomes optional, what follows itself becomes repeated, and text that differs
becomes a slot.  The wrapper then says which slots hold the article.
"""

from __future__ import annotations

import difflib
import re
from collections import defaultdict

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharelens.llm.common import small_batches, stored
from sharelens.llm.html_pages import ROOT, blocks_of, read_page

FAN_IN = 256
LEAST_PAGES = 5
MENU_SHARE = 0.9

# What names the article, and what names everything else.
MAIN_TAGS = ("article", "main")
MAIN_MARKS = re.compile(r"role=main|itemprop=articlebody|=(article|post|entry|story)([-_]?(body|content|text))?\b|=content\b|=main\b")
AWAY_TAGS = {"nav", "footer", "aside", "form", "dialog", "menu", "fieldset", "search"}
AWAY_ROLES = re.compile(r"role=(navigation|banner|contentinfo|complementary|search|dialog|alert|menu)\b")
AWAY_WORDS = set(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie "
    "cookies disclaimer disqus footer gdpr login masthead menu modal navbar navigation nav newsletter notice notices "
    "pager pagination paywall popup promo promoted promotion related replies respond search share sharing sidebar "
    "signup social sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
# What may stand beside such words in one name, as in ``ad-box`` and ``site-footer``; not so in ``ad-hoc``.
PLACE_WORDS = set(
    "area article articles bar block bottom box btn button buttons col column container content entry form global "
    "group header inline inner item items left link links list main mobile outer page panel post posts primary right "
    "row secondary section site slot sticky text title top unit wrap wrapper".split()
)
# The only words that count in an id inside the article, where ids are often made from headings.
READER_WORDS = set("comment comments commentlist disqus replies respond".split())
TEXT_TAGS = set("blockquote h1 h2 h3 h4 h5 h6 p pre".split())
# What can be a menu if (almost) all its text is linked.
MENU_TAGS = set("a center dir div dl li ol section span table tbody td tr ul".split())
# What names a line of the host's own within an article, if all its pages have it alike.
NOTICE_WORDS = set("boilerplate cta hint hints reminder".split())
_WORD = re.compile(r"[a-z]+")

SEEN_SCHEMA = """host string, shape string, path long, pages long, low long, high long, chars long, link_chars long, body long"""
SHAPE_SCHEMA = "host string, shape string, pages long"
RULE_SCHEMA = "host string, main array<long>, constant array<long>"


def is_away(key: str, inside_main: bool = False) -> bool:
    """Does the element's tag, role, class or id name it as something around the article?"""
    tag, _, marks = key.partition(" ")
    if tag in AWAY_TAGS or (tag == "header" and not inside_main):
        return True
    if tag in ("html", "body") or not marks:
        return False
    if AWAY_ROLES.search(marks):
        return True
    for mark in marks.split(" "):
        kind, _, name = mark.partition("=")
        if kind == "role" or (kind == "id" and tag in TEXT_TAGS):
            continue
        words = set(_WORD.findall(name))
        named = words & (READER_WORDS if kind == "id" and inside_main else AWAY_WORDS)
        if named and words <= AWAY_WORDS | PLACE_WORDS:
            return True
    return False


def is_notice(key: str) -> bool:
    """Do the element's own marks name it as a line that may be the host's?"""
    return any(w in NOTICE_WORDS for w in _WORD.findall(key.partition(" ")[2]))


def notices(entries: list[tuple]) -> set[int]:
    """The paths of such elements and of what is in them."""
    found: set[int] = set()
    for path, parent, key, _, _ in entries:
        if parent in found or is_notice(key):
            found.add(path)
    return found


def surroundings(entries: list[tuple], main=frozenset()) -> set[int]:
    """The paths around the article."""
    away, within = set(), set()
    for path, parent, key, _, _ in entries:
        if parent in away or is_away(key, parent in within):
            away.add(path)
        if parent in within or path in main or key.split(" ")[0] in MAIN_TAGS:
            within.add(path)
    return away


def text_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


def pack_shape(entries: list[tuple]) -> str:
    """Entries ``(path, parent, key, optional, repeated)`` as one line each."""
    return "\n".join(f"{p} {q} {int(o)}{int(r)} {k}" for p, q, k, o, r in entries)


def unpack_shape(shape: str) -> list[tuple]:
    out = []
    for line in shape.split("\n") if shape else ():
        path, parent, flags, key = line.split(" ", 3)
        out.append((int(path), int(parent), key, flags[0] == "1", flags[1] == "1"))
    return out


def align(wrapper: list[tuple], stream: list[tuple]) -> list[tuple]:
    """The shortest sequence found that matches both; what one side lacks is optional."""
    if [e[0] for e in wrapper] == [e[0] for e in stream]:
        return [(a[0], a[1], a[2], a[3] or b[3], a[4] or b[4]) for a, b in zip(wrapper, stream)]
    left, right = [e[0] for e in wrapper], [e[0] for e in stream]
    in_left, in_right = set(left), set(right)
    other = {e[0]: e for e in stream}
    out, placed = [], set()

    def put(entry, optional):
        if entry[0] not in placed:
            placed.add(entry[0])
            out.append((entry[0], entry[1], entry[2], optional, entry[4]))

    for op, a, b, c, d in difflib.SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
        for e in wrapper[a:b]:
            twin = other.get(e[0])
            put((*e[:4], e[4] or bool(twin and twin[4])), e[3] or e[0] not in in_right or bool(twin and twin[3]))
        if op != "equal":
            for e in stream[c:d]:
                if e[0] not in in_left:
                    put(e, True)
    return out


def wrapper_text(entries: list[tuple], slots=frozenset()) -> str:
    """The wrapper as a regular expression, for people to read."""
    children = defaultdict(list)
    for e in entries:
        children[e[1]].append(e)
    out, todo = [], [("open", e) for e in reversed(children[ROOT])]
    while todo:
        step, e = todo.pop()
        mark = "*" if e[3] and e[4] else "?" if e[3] else "+" if e[4] else ""
        if step == "open":
            out.append(("(" if mark else "") + f"<{e[2]}>" + ("#TEXT" if e[0] in slots else ""))
            todo.append(("close", e))
            todo += [("open", c) for c in reversed(children[e[0]])]
        else:
            out.append(f"</{e[2].split(' ')[0]}>" + (")" + mark if mark else ""))
    return "".join(out)


def page_facts(pages: DataFrame) -> DataFrame:
    """What the wrappers need: per host the distinct streams, and facts on each text slot.

    Combined within every batch, so that copies and common shapes shrink before any shuffle.
    """

    def run(batches):
        for batch in batches:
            shapes, slots, bodies = defaultdict(int), {}, set()
            for host, page in zip(batch.column("host").to_pylist(), batch.column("_html").to_pylist()):
                elements, pieces = read_page(page)
                entries = [(e.path, e.parent, e.key, False, e.repeated) for e in elements]
                shapes[host, pack_shape(entries)] += 1
                own = {}
                for piece in pieces:
                    text = piece.text.strip()
                    if text:
                        fact = own.setdefault(piece.path, ["", 0, 0])
                        fact[0] += "\n" + text
                        fact[1] += len(text)
                        fact[2] += len(text) if piece.linked else 0
                marked = notices(entries)
                if marked:
                    marked |= surroundings(entries)
                    rest = [f"{path} {fact[0]}" for path, fact in own.items() if path not in marked]
                    bodies.add((host, text_hash("\n".join(rest))))
                for path, (text, chars, link_chars) in own.items():
                    code = text_hash(text)
                    fact = slots.setdefault((host, path), [0, code, code, 0, 0])
                    fact[0] += 1
                    fact[1], fact[2] = min(fact[1], code), max(fact[2], code)
                    fact[3] += chars
                    fact[4] += link_chars
            rows = [(h, s, None, n, None, None, None, None, None) for (h, s), n in shapes.items()]
            rows += [(h, None, p, *f, None) for (h, p), f in slots.items()]
            rows += [(h, *[None] * 7, b) for h, b in bodies]
            kinds = [pa.string(), pa.string(), *[pa.int64()] * 7]
            columns = list(zip(*rows)) or [()] * 9
            names = ["host", "shape", "path", "pages", "low", "high", "chars", "link_chars", "body"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return pages.mapInArrow(run, SEEN_SCHEMA)


def host_wrappers(shapes: DataFrame) -> DataFrame:
    """``host, shape, pages``: one wrapper a host, from its distinct streams.

    Streams are aligned in groups of about ``FAN_IN``, then the groups' wrappers, until
    each host has one; no task sees more of a host than one group.
    """

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["pages", "shape"], ascending=[False, True])
        wrapper = None
        for shape in rows["shape"]:
            stream = unpack_shape(shape)
            wrapper = stream if wrapper is None else align(wrapper, stream)
        return pd.DataFrame(
            {"host": [rows["host"].iat[0]], "shape": [pack_shape(wrapper)], "pages": [rows["pages"].sum()]}
        )

    turn = 0
    while True:
        counts = stored(shapes.groupBy("host").agg(F.count(F.lit(1)).alias("n")), f"host_shapes_{turn}")
        groups = F.ceil(F.col("n") / FAN_IN)
        dealt = shapes.join(counts, "host").withColumn("_group", F.pmod(F.xxhash64("shape"), groups))
        shapes = stored(
            dealt.drop("n").groupBy("host", "_group").applyInPandas(merge, SHAPE_SCHEMA),
            f"wrappers_{turn}",
        )
        if (counts.agg(F.max("n")).first()[0] or 0) <= FAN_IN:
            return shapes
        turn += 1


def common_ancestor(free: list[tuple], facts: dict[int, tuple]) -> tuple[list[int], set[int]]:
    """The deepest element with all the text that is not in menus, and the menus around it.

    ``free``: the entries that are not around the article.  ``ROOT`` is the page itself.
    """
    tag_of = {e[0]: e[2].split(" ")[0] for e in free}
    children, text, links = defaultdict(list), defaultdict(int), defaultdict(int)
    for path, parent, _, _, _ in free:
        children[parent].append(path)
    for path in (ROOT, *tag_of):
        if path in facts:
            text[path], links[path] = facts[path][2:4]
    own = {path: text[path] - links[path] for path in (ROOT, *tag_of)}
    for path, parent, _, _, _ in reversed(free):  # parents come before children
        text[parent] += text[path]
        links[parent] += links[path]
    menus = {p for p, tag in tag_of.items() if tag in MENU_TAGS and text[p] and links[p] >= MENU_SHARE * text[p]}
    at = ROOT
    while True:
        holds = [p for p in children[at] if text[p] and p not in menus]
        if own[at] or len(holds) != 1 or tag_of[holds[0]] in ("p", "b", "i", "span", "a"):
            break
        at = holds[0]
    # Lists of links in or after the text may be the article's; so are links beside an element's own text.
    kids = children[at]
    if at == ROOT or tag_of[at] in ("html", "body"):
        outside = [p for p in kids if not (own[at] and tag_of[p] in ("a", "span"))]
    else:
        again = {e[0] for e in free if e[4]}
        outside = [p for p in kids[: kids.index(holds[0])] if p not in again] if holds and not own[at] else []
    return [at], menus.intersection(outside)


def rule_of(
    entries: list[tuple], facts: dict[int, tuple], pages: int = 1, bodies: int = 0
) -> tuple[list[int], list[int]]:
    """The paths that hold the article, and the slots in them that are left out.

    ``facts``: path -> (pages, constant, chars, link_chars).  The host's own are slots
    whose marks name a notice, alike on all ``pages``, which have ``LEAST_PAGES`` distinct
    ``bodies`` besides.  An ``article`` or ``main``
    comes first, then a class or id that names the article, then the deepest element
    with all of the text that is neither in menus nor around the article; its menus are
    among the slots left out.
    """
    key_of = {e[0]: e[2] for e in entries}
    parent_of = {e[0]: e[1] for e in entries}
    away = surroundings(entries)
    free = [e[0] for e in entries if e[0] not in away]
    main = [p for p in free if key_of[p].split(" ")[0] == "article"]
    main = main or [p for p in free if key_of[p].split(" ")[0] == "main"]
    main = main or [p for p in free if key_of[p].split(" ")[0] in ("div", "section", "td") and MAIN_MARKS.search(key_of[p])]
    menus: set[int] = set()
    if not main:
        main, menus = common_ancestor([e for e in entries if e[0] not in away], facts)
    top = set(main)
    inner, left_out = set(top & {ROOT}), set()
    for path in free:
        if path in top or parent_of[path] in inner:
            inner.add(path)
        if path in menus or parent_of[path] in left_out:
            left_out.add(path)
    marked = notices([e for e in entries if e[0] in inner and e[0] not in top])
    known = [p for p in facts if p in marked and facts[p][1] and facts[p][0] == pages]
    return sorted(top), sorted(left_out.union(known if bodies >= LEAST_PAGES else ()))


def host_rules(wrappers: DataFrame, slots: DataFrame, bodies: DataFrame) -> DataFrame:
    """``host, main, constant`` from each host's wrapper, the facts on its slots and its count of bodies."""
    facts = slots.groupBy("host").agg(
        F.collect_list(F.struct("path", "pages", "low", "high", "chars", "link_chars")).alias("facts")
    )

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                known = {
                    f["path"]: (f["pages"], f["low"] == f["high"], f["chars"], f["link_chars"])
                    for f in r["facts"] or ()
                }
                rows.append((r["host"], *rule_of(unpack_shape(r["shape"]), known, r["pages"], r["bodies"] or 0)))
            kinds = (pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "main", "constant"]
            )

    return wrappers.join(facts, "host", "left").join(bodies, "host", "left").mapInArrow(run, RULE_SCHEMA)


def article(page: str, main: set[int], constant: set[int]) -> str:
    """The page's text in the wrapper's article slots.

    A page without the host's article element is read by the same rule on its own.
    """
    elements, pieces = read_page(page)
    entries = [(e.path, e.parent, e.key, False, e.repeated) for e in elements]
    if ROOT not in main and not any(e[0] in main for e in entries):
        facts = {}
        for piece in pieces:
            n = len(piece.text.strip())
            if n:
                old = facts.get(piece.path, (1, False, 0, 0))
                facts[piece.path] = (1, False, old[2] + n, old[3] + n * piece.linked)
        main, constant = map(set, rule_of(entries, facts))
    away, inside = surroundings(entries, main), main & {ROOT}
    for path, parent, _, _, _ in entries:
        if path not in away and (path in main or parent in inside):
            inside.add(path)
    if not entries:
        return blocks_of(pieces)
    return blocks_of([p for p in pieces if p.path in inside and p.path not in constant])


def extract_articles(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """The main text of every row of ``pages``.

    Returns ``page_id, url, text, n_chars``.  Blocks are parted by an empty line, white
    space in a block is one space, character references are decoded; menus, headers,
    footers, sidebars, notices, adverts, forms, scripts, styles and comments are left
    out.  A line that is marked as a hint or the like, and that every page of a host has
    alike, is the host's own and is left out too, if the pages have ``LEAST_PAGES``
    distinct texts besides.  Nothing else is left out for being the same on many pages.
    A class or id names an advert or the like only as a whole: ``ad-box`` does, ``ad-hoc``
    does not; no id takes a heading or paragraph away, and inside the article only those
    of reader comments count.

    NULL html counts as empty and gives an empty text; text without any markup is taken
    as it is.  A page without url belongs to the host ''.  Repeated rows and NULL ids
    are rows like others; other columns are not read; an empty table gives no rows.
    """
    small_batches(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    slim = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        host.alias("host"),
        F.coalesce(F.col(html_col), F.lit("")).alias("_html"),
    )
    facts = stored(page_facts(slim.select("host", "_html")), "facts")
    shapes = facts.where(F.col("shape").isNotNull()).groupBy("host", "shape").agg(F.sum("pages").alias("pages"))
    slots = facts.where(F.col("path").isNotNull()).groupBy("host", "path").agg(
        F.sum("pages").alias("pages"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("chars").alias("chars"), F.sum("link_chars").alias("link_chars"),
    )
    bodies = facts.where(F.col("body").isNotNull()).groupBy("host").agg(F.countDistinct("body").alias("bodies"))
    rules = stored(host_rules(host_wrappers(stored(shapes, "shapes")), slots, bodies), "rules")

    def run(batches):
        for batch in batches:
            texts = [
                article(page, set(main or ()), set(constant or ()))
                for page, main, constant in zip(*(batch.column(c).to_pylist() for c in ("_html", "main", "constant")))
            ]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            columns.append(pa.array([len(t) for t in texts], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    id_type = slim.schema["page_id"].dataType.simpleString()
    schema = f"page_id {id_type}, url string, text string, n_chars long"
    return slim.join(rules, "host", "left").mapInArrow(run, schema)
