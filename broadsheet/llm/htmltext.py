"""Main text of web pages by line-block distribution.

The page is read as a stream of tags and text. Scripts, styles, forms and the like are dropped with what they
hold, and each block-level element gives one line, white space inside turned into single spaces and
character references decoded. Each line has the length of its text outside links; lines that stand in a part
which names itself as a menu, header, footer, sidebar, notice, advert, form or comments have none. Such names by class or
identifier, and forms, are only a sign: an element that carries one but holds the page's main element, title or margins
and nearly all text is a wrapper, and its sign is lifted. The lengths are
summed over windows of WINDOW lines. A surge is a window whose sum rises to a share of the page's typical
line length (weighted by characters) and stays; the dive is the first window after it that holds no text at
all. Of the stretches between surge and dive the one with the most text is the article, and those within
the same named main element (article, main) belong to it. Where a page names a main element, the stretch
is sought within it first. Where it names none, the element that holds most of the stretch's text is the article's
container; other stretches with text in it, and the lines of it between them, belong to the article, too.

Nulls: null or empty html gives an empty text. Unclosed and stray tags end with the element around them;
an unfinished tag at the end of the page is no text. Whole pages are read, whatever their length.
Repeated rows give equal rows. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import slices

WINDOW = 3
#: A surge reaches this share of the typical line length.
SURGE = 0.2
#: A wrapper's sign is lifted where the text outside is less than this share of the text within.
LIFT = 0.1

# fixed values: element names of HTML, and words by which page parts name themselves
_BLOCKS = frozenset("address article aside blockquote body br caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td template textarea tfoot th thead title tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INNER = frozenset("address blockquote br caption center dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr legend li ol p pre section summary table tbody tfoot thead tr ul".split())
_RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
_DROPPED = frozenset("script style textarea title noscript iframe noembed noframes xmp head template button select option optgroup datalist input label svg math canvas object embed audio video map dialog".split())
_MARGINAL = frozenset("nav header footer aside menu".split())
_MAIN = frozenset("article main".split())
_NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|breadcrumbs?|comments?|commentlist|cookies?|consent|disqus|discussion|disclaimer|footer|foot|gdpr|header|masthead|menu|nav|navbar|navigation|newsletter|notices?|notification|pagination|pager|popup|modal|promo\w*|related|recommended|respond|share|sharing|sidebar|side|social|sponsor\w*|subscribe|subscription|toolbar|topbar|widgets?|alert)(?=$|[\s_-])",
    re.I,
)
_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar toolbar alert dialog form".split())
_COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|respond)(?=$|[\s_-])", re.I)
_DENIED = re.compile(r"(?:^|(?<=[\s_-]))(?:no|has|with|without|hide)[_-][a-z]+", re.I)
_CHAPTERS = frozenset("discussion disclaimer notice notices".split())
# end of fixed values

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WHITE = re.compile(r"\s+")
#: Elements that the start of another one of their kind, or of one of these, closes.
_CLOSES = {"p": _BLOCKS - {"br"}, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr"}), "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}), "option": frozenset({"option", "optgroup"})}


def _marginal(name: str, attributes: str, main: int) -> tuple[int, bool]:
    """2 if the element is a margin, 1 if a name or being a form is a sign of it, else 0; whether the name is one of comments."""
    if name in _MARGINAL:
        return 2, False
    sign, comments = int(name == "form"), False
    if not attributes or name in ("html", "body") or name in _MAIN:
        return sign, False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            return 2, False
        if key == "role" and value.lower() in _ROLES:
            return 2, False
        if key in ("class", "id") and _NAMED.search(_DENIED.sub("", value)) and not (name == "section" and main and value.lower() in _CHAPTERS):
            sign, comments = 1, comments or bool(_COMMENTS.search(value))
    return sign, comments


class Line:
    """One block's text: its parts, characters within links, and where it stands."""

    __slots__ = ("homes", "linked", "main", "margin", "parts", "signs")

    def __init__(self, margin: bool, signs: tuple[int, ...], main: int, homes: tuple[int, ...]) -> None:
        self.parts: list[str] = []
        self.linked = 0
        self.margin, self.signs, self.main, self.homes = margin, signs, main, homes


def lines(page: str) -> list[tuple[str, int, bool, int, tuple[int, ...]]]:
    """(text, characters outside links, marginal, number of the main element or 0, containers) of every block with text.

    A container is a block that may hold paragraphs, by its number in the page, 0 for the page. Text that stands in one
    without a paragraph has two: that one, which may be a paragraph itself, and the next around it.
    """
    out: list[Line] = []
    open_: list[tuple[str, bool, bool, tuple[int, ...], int, int]] = []  # name, dropped, margin, elements with a sign, main, number
    wrappers: dict[int, bool] = {}  # elements with a sign that hold a title, a margin or (True) a main element; forms
    comments: set[int] = set()
    line: Line | None = None
    mains = links = at = elements = 0

    def homes() -> tuple[int, ...]:
        direct, found = True, []
        for name, *_, number in reversed(open_):
            if name in _BLOCKS and name not in _INNER:
                found.append(number)
                if len(found) == 1 + direct:
                    return tuple(found)
            elif name in _BLOCKS and not found:
                direct = False
        return (*found, 0)

    def put(text: str) -> None:
        nonlocal line
        if not text or (open_ and open_[-1][1]):
            return
        margin, signs, main = open_[-1][2:5] if open_ else (False, (), 0)
        if line is None or (line.margin, line.signs, line.main) != (margin, signs, main):
            line = Line(margin, signs, main, homes())
            out.append(line)
        line.parts.append(text)
        if links:
            line.linked += len(text)

    size, search = len(page), _TOKEN.search
    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            put(page[at:])
            break
        put(page[at:begin])
        token = _TOKEN.match(page, begin)
        if token is None:  # a bare < is text, but for a tag that the page's end cuts off
            if begin + 1 < size and (page[begin + 1].isalpha() or page[begin + 1] == "/") and search(page, begin) is None and page.find(">", begin) < 0:
                break
            put("<")
            at = begin + 1
            continue
        at = token.end()
        name = (token[2] or "").lower()
        if not name:
            continue
        block = name in _BLOCKS
        if block:
            line = None
        if token[1]:
            for depth in range(len(open_) - 1, -1, -1):
                if open_[depth][0] == name:
                    links -= sum(x[0] == "a" for x in open_[depth:])
                    del open_[depth:]
                    break
            continue
        while open_ and name in _CLOSES.get(open_[-1][0], ()):
            open_.pop()
        if block and name != "br":  # a block also ends a paragraph left open below inline elements
            for depth in range(len(open_) - 1, -1, -1):
                if open_[depth][0] == "p" and name in _CLOSES["p"]:
                    links -= sum(x[0] == "a" for x in open_[depth:])
                    del open_[depth:]
                    break
                if open_[depth][0] in _BLOCKS:
                    break
        if name in _VOID or token[3].endswith("/") and name not in _BLOCKS:
            continue
        _, dropped, margin, signs, main, _ = open_[-1] if open_ else ("", False, False, (), 0, 0)
        own, of_comments = _marginal(name, token[3], main)
        inside = name in _MAIN and not main and not margin
        if inside:
            mains += 1
        # a header within the main element holds its title
        if own == 2 and main and name == "header" and not _NAMED.search(token[3]):
            own = 0
        elements += 1
        if inside or own == 2 or name == "h1":
            for x in signs:
                wrappers[x] = wrappers.get(x, False) or inside
        if own == 1:
            signs = (*signs, elements)
            if of_comments:
                comments.add(elements)
            elif name == "form":
                wrappers[elements] = False
        open_.append((name, dropped or name in _DROPPED, margin or own == 2, signs, mains if inside else main, elements))
        links += name == "a"
        if name in _RAW:
            closing = re.compile(f"</{re.escape(name)}\\b", re.I).search(page, at)
            if closing is None:
                break
            at = closing.start()
    found = []
    for x in out:
        text = _WHITE.sub(" ", html.unescape("".join(x.parts))).strip()
        if text:
            plain = len(text) * (1 - x.linked / max(1, sum(map(len, x.parts))))
            found.append((text, round(plain), x.margin, x.signs, x.main, x.homes))
    lifted = _lifted(found, {k: v for k, v in wrappers.items() if k not in comments})
    return [(text, plain, margin or not lifted.issuperset(signs), main, home) for text, plain, margin, signs, main, home in found]


def _lifted(found: list[tuple], wrappers: dict[int, bool]) -> set[int]:
    """The elements whose sign does not count. wrappers: those that may be one, and whether they hold a main element."""
    lifted: set[int] = set()
    while True:
        free, named, held = 0, False, Counter()
        for _, plain, margin, signs, main, _ in found:
            if margin:
                continue
            if left := [x for x in signs if x not in lifted]:
                held[left[0]] += plain
            else:
                free += plain
                named = named or bool(main)
        wide = [x for x, n in held.items() if x in wrappers and (free < LIFT * n or wrappers[x] and not named and n >= free)]
        if not wide:
            return lifted
        lifted.add(max(wide, key=lambda x: (held[x], -x)))


def stretches(weights: np.ndarray, window: int = WINDOW, surge: float = SURGE) -> list[tuple[int, int]]:
    """(first, end) of the runs of lines between a surge and the next dive of the window sums."""
    if not weights.any():
        return []
    sums = np.convolve(weights, np.ones(window, np.int64))[window - 1 :]  # the window that begins at each line
    level = surge * float((weights.astype(float) ** 2).sum() / weights.sum())
    found, start = [], None
    for i in range(len(weights)):
        if start is None and weights[i] > 0 and sums[i] >= level:
            start = i
        elif start is not None and sums[i] == 0:
            found.append((start, i))
            start = None
    if start is not None:
        found.append((start, len(weights)))
    # a short line right before a surge, such as a title, belongs to it
    out = []
    for first, end in found:
        while first and weights[first - 1] > 0 and (not out or first > out[-1][1]):
            first -= 1
        out.append((first, end))
    return out


def main_text(page: str | None) -> str:
    """The article's blocks in page order, joined by a line break; empty if there is none."""
    found = lines(page or "")
    body = [x for x in found if x[3] and not x[2]]
    rows = [x if not body or x[3] else (x[0], 0, True, 0, ()) for x in found]
    if not rows:
        return ""
    weights = np.array([0 if marginal else plain for _, plain, marginal, _, _ in rows], np.int64)
    runs = stretches(weights)
    if not runs:
        return ""
    first, end = max(runs, key=lambda r: int(weights[r[0] : r[1]].sum()))
    top = {rows[i][3] for i in range(first, end)} - {0}
    inside = set(range(first, end))
    if not body:
        held: Counter[int] = Counter()
        for i in inside:
            for home in rows[i][4]:
                held[home] += int(weights[i])
        home = max(held, key=lambda x: (held[x], x))  # of two that hold the same, the inner one
        same = [r for r in runs if any(weights[i] and home in rows[i][4] for i in range(*r))]
        for r in same:
            inside.update(range(*r))
        inside.update(i for i in range(same[0][0], same[-1][1]) if weights[i] and home in rows[i][4])
    picked = [i for i, row in enumerate(rows) if not row[2] and (i in inside or row[3] in top)]
    return "\n".join(rows[i][0] for i in picked)


def extract(pages: DataFrame, keep: dict[str, str], html_col: str = "html") -> DataFrame:
    """Adds text and n_chars to the columns in keep (name to type)."""
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])

    inputs = [F.col(n) for n in names] + [F.col(html_col).alias("html")]
    return pages.select(*inputs).mapInArrow(run, ", ".join([*(f"`{n}` {t}" for n, t in keep.items()), "text string, n_chars long"]))


def op6(pages: DataFrame) -> DataFrame:
    return extract(pages, {"page_id": "long", "url": "string"})
