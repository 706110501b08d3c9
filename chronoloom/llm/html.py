"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Pass one decides each block on its own: blocks inside navigation, headers,
footers, asides, forms or containers whose class, id or role names an advert, sidebar, notice or comments are
boilerplate, as are blocks of mostly linked text (in an article only those in lists); long blocks are main text if their share
of stop words, or inside an article element their length alone, speaks for it. The others stay ambiguous.
A name alone never rejects a container with most of the page's dense prose or of its article text; words of readers,
notices and teasers do while dense prose stands outside. A page whose long blocks hold no stop word goes by length and
links. Names count where every part of one speaks for it: "share-buttons" does, "related-work" does not.
Omitted end tags follow the rules of HTML trees: a head ends at what cannot stand in it, a paragraph at the next block, an
item, cell or option at its like, a button or select at a block; an end tag closes nothing across a block or a table cell.
Tags are read in one pass, in linear time whatever the markup: each open element's place is known by name.
Pass two labels the ambiguous from the nearest neighbours that density decided, whatever containers say of others: inside an
article they are main text; a heading goes by what follows; a short block by the nearest neighbour, main text in a tie, but
before the first and behind the last of them only what ends like a sentence; a long block with few stop words is main text
if no neighbour is boilerplate. Where density decided nothing, what no container or link spoke against is main text.

Defined results: null and empty html have the empty text; broken markup ends at the page's end; repeated rows repeat; whole
pages of any length are read; an empty table gives no rows; other columns, of whatever name, are not looked at.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from chronoloom.llm.common import slices, small_batches

#: Characters of a short block and of a long one; share of stop words that speaks for and against; share of linked text.
SHORT, LONG, STOP_HIGH, STOP_LOW, LINKED = 70, 200, 0.30, 0.12, 0.5

#: Marks that end a sentence, and those that may follow them.
CLOSING, QUOTES = (".", "!", "?", ":", ";", "\u2026", "\u3002", "\uff01", "\uff1f"), "\"')]\u00bb\u201d\u2019"

#: Elements that begin and end a block.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is raw up to their end tag.
RAW_TAGS = frozenset("script style textarea noscript iframe title".split())
#: Headings.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An element ends at its like and at these, unless an element of the second list was opened within.
ENDS_AT = {
    "li": ("li".split(), "ul ol menu dir".split()), "dt": ("dt dd".split(), ["dl"]), "dd": ("dt dd".split(), ["dl"]), "option": (["option"], ["select"]), "optgroup": ("option optgroup".split(), ["select"]),
    "tr": ("tr td th caption".split(), ["table"]), "td": ("td th caption".split(), ["table"]), "th": ("td th caption".split(), ["table"]),
    "tbody": ("thead tbody tfoot tr td th caption".split(), ["table"]), "thead": ("tbody caption".split(), ["table"]), "tfoot": ("thead tbody tr td th caption".split(), ["table"]),
}
#: Block elements that may stand in a paragraph's place only after its end do not include these.
NO_END_OF_P = frozenset("body caption head html legend optgroup option tbody td tfoot th thead title tr".split())
#: No end tag closes an element outside of these.
SCOPES = frozenset("table td th caption template object".split())
#: Parts of tables, whose end tags do reach out of cells.
TABLE_PARTS = frozenset("table caption tbody thead tfoot tr td th".split())
#: Elements without blocks in them: the next block ends them. An article ends any silent element.
PHRASE_ONLY = frozenset("button select svg math".split())
#: Elements whose content is never text.
SILENT_TAGS = frozenset("script style noscript template svg math iframe object canvas textarea select button head title audio video".split())
#: Elements that hold boilerplate.
CHROME_TAGS = frozenset("nav header footer aside form menu dialog".split())
#: Words in class, id or role that mark boilerplate.
CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary contentinfo consent cookie cookies "
    "copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification popup promo "
    "promoted recommended related replies reply respond search share sharing shoutbox sidebar signup skip social sponsor sponsored subscribe subscription "
    "tags toolbar widget widgets".split()
)
#: Words that make a name tell the state of a page, not what the element is.
STATE_WORDS = frozenset("has no with without".split())
#: Words that may stand beside those in a name.
NEUTRAL_WORDS = frozenset(
    "area article articles bar block blocks body bottom box btn button buttons col column container content desktop div element elements entries entry fixed footer form group head heading "
    "holder icon icons inner inline item items js layout left lg link links list lists main md message mobile module news outer page panel plugin post posts primary region right row secondary section "
    "site slot sm small sticky stories story text title top unit view wrap wrapper zone".split()
)
#: Words of containers that may hold more prose than the main text.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising comment comments consent cookie cookies copyright disclaimer disqus gdpr newsletter notice notices promo "
    "promoted recommended related replies reply respond shoutbox sponsor sponsored".split()
)
#: Elements that may stand in a head.
HEAD_TAGS = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
#: Elements that never have content.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Frequent words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    "a an and are as at be been but by for from had has have he her his i in is it its no not of on one only or our she so that the their there they this to "
    "was we were what when which who will with would you au aux avec ce ces cette dans de des du elle en est et eux il je la le les leur lui ma mais me meme mes "
    "moi mon ne nos notre nous on ou par pas pour qu que qui sa se ses son sur ta te tes toi ton tu un une vos votre vous aber alle als also am an auch auf aus "
    "bei bin bis bist da damit das dass dein dem den der des die dir doch dort du durch ein eine einem einen einer er es euer für hatte ich ihr ihre im in ist "
    "ja kann mein mich mir mit nach nicht noch nun nur ob oder ohne sein sich sie sind so und uns unter vom von vor war was wenn wer wie wir wird zu zum zur "
    "al algo ante como con cual cuando del donde ella ellos era es esa ese eso esta este esto hay hasta las lo los mas mi muy nada ni nos o os para pero poco "
    "por porque que quien si sin sobre su sus también tan te tiene todo tu un una uno y ya".split()
)

#: A tag, with quoted, bare or no values of attributes; the same without regard to quotes, for markup in which they do not close.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?)*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORD = re.compile(r"\w+")


class Block:
    """Text of one block and where it stands: its innermost named container, and that around its article; -1 for none."""

    __slots__ = ("parts", "linked", "heading", "item", "chrome", "article", "named", "held", "text", "label")

    def __init__(self, heading: bool, item: bool, chrome: bool, article: bool, named: int, held: int):
        self.parts: list[str] = []
        self.linked, self.heading, self.item, self.chrome, self.article = 0, heading, item, chrome, article
        self.named, self.held = named, held
        self.text, self.label = "", ""


def chrome_words(attributes: str) -> set[str]:
    """Words of class, id and role that mark boilerplate."""
    found: set[str] = set()
    for match in _NAMES.finditer(attributes):
        for name in next(x for x in match.groups() if x is not None).lower().split():
            pieces = {x for x in _SPLIT.split(name) if x}
            if not STATE_WORDS.intersection(pieces) and pieces <= CHROME_WORDS | NEUTRAL_WORDS | {x for x in pieces if len(x) < 3}:
                found |= CHROME_WORDS & pieces
    return found


def stop_words(text: str) -> tuple[int, int]:
    """Stop words and words."""
    found = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in found), len(found)


def weight(text: str) -> int:
    """Length, with three for a character of a script that writes words in one or two."""
    return len(text) + 2 * sum(x >= "\u2e80" for x in text)


class Container(NamedTuple):
    """A container whose names speak against it; the one around it, which stands before it in the list, or -1."""

    names: set[str]
    article: bool
    around: int


def acquit(found: list[Block], containers: list[Container]) -> None:
    """Marks the blocks of named containers, except of those that hold the page's prose or its article."""
    if not containers:
        return
    free = [b for b in found if not b.chrome and b.linked <= LINKED * len(b.text)]
    prose, inside = 0, [0] * len(containers)
    told, holds = 0, [0] * len(containers)
    for b in free:
        stops, words = stop_words(b.text)
        dense = len(b.text) if len(b.text) >= SHORT and stops >= STOP_LOW * words else 0
        prose += dense
        if b.named >= 0:
            inside[b.named] += dense
        if b.article:
            told += len(b.text)
            if b.held >= 0:
                holds[b.held] += len(b.text)
    # What a container holds counts for those around it, from the innermost on.
    for c in range(len(containers) - 1, -1, -1):
        if (around := containers[c].around) >= 0:
            inside[around] += inside[c]
            holds[around] += holds[c]
    guilty = [False] * len(containers)
    for c, (names, within, around) in enumerate(containers):
        # Beside an article only what holds it is the main text.
        most = 2 * inside[c] > prose if within or not told else 2 * holds[c] >= told
        outside = prose - inside[c]
        guilty[c] = not most or bool(outside and names & ASIDE_WORDS) or (around >= 0 and guilty[around])
    for b in found:
        b.chrome = b.chrome or (b.named >= 0 and guilty[b.named])


class Open(NamedTuple):
    """An open element: inside boilerplate, inside an article, the innermost named container, that around the article."""

    tag: str
    chrome: bool = False
    article: bool = False
    named: int = -1
    held: int = -1


class Tree:
    """The open elements of a page, and the blocks with text that stand in them."""

    def __init__(self) -> None:
        self.found: list[Block] = []
        self.containers: list[Container] = []
        self.stack = [Open("")]
        self.places: dict[str, list[int]] = {}  # tag -> places in the stack
        self.blocks: list[int] = []  # places of block elements
        self.silent = 0
        self.current: Block | None = None

    def last(self, tags: Iterable[str]) -> int:
        """The place of the innermost open element with one of the tags, or 0."""
        return max((x[-1] for t in tags if (x := self.places.get(t))), default=0)

    def pop(self, place: int) -> None:
        """Closes the element at a place and all in it."""
        while len(self.stack) > place:
            tag = self.stack.pop().tag
            if tag:
                self.places[tag].pop()
                self.silent -= tag in SILENT_TAGS
                if tag in BLOCK_TAGS:
                    self.blocks.pop()

    def text(self, text: str) -> None:
        if self.stack[-1].tag == "head" and text and not text.isspace():
            self.pop(len(self.stack) - 1)
        if self.silent or not text:
            return
        if self.current is None:
            if text.isspace():
                return
            self.current = Block(any(map(self.places.get, HEADINGS)), bool(self.places.get("li")), *self.stack[-1][1:])
            self.found.append(self.current)
        text = entities.unescape(text)
        self.current.parts.append(text)
        if self.places.get("a"):
            self.current.linked += len(text)

    def end(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.current = None
        place = self.last(HEADINGS) if tag in HEADINGS else self.last([tag])
        if not place:
            return
        if tag in BLOCK_TAGS or tag in SILENT_TAGS:
            if tag in TABLE_PARTS or self.last(SCOPES) <= place:
                self.pop(place)
        elif not self.blocks or self.blocks[-1] < place:
            self.pop(place)
        elif tag == "a":
            # A link around blocks ends alone; they stay open.
            self.places["a"].pop()
            self.stack[place] = self.stack[place]._replace(tag="")

    def start(self, tag: str, attributes: str) -> None:
        if tag not in HEAD_TAGS and self.stack[-1].tag == "head":
            self.pop(len(self.stack) - 1)
        if tag == "br":
            if self.current is not None:
                self.current.parts.append(" ")
            return
        if tag in BLOCK_TAGS:
            self.current = None
            if tag not in NO_END_OF_P and (place := self.last(["p"])) and place > self.last(SCOPES):
                self.pop(place)
            if tag not in ("option", "optgroup", "title", "head", "html", "body") and (place := self.last(PHRASE_ONLY)):
                self.pop(place)
            if tag in ("article", "main", "body") and self.silent and (place := self.last(SILENT_TAGS - {"template"})):
                self.pop(place)
            if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
                self.pop(len(self.stack) - 1)
        if tag in ENDS_AT:
            ending, within = ENDS_AT[tag]
            edge = self.last(within)
            if places := [x[-1] for t in ending if (x := self.places.get(t)) and x[-1] > edge]:
                self.pop(min(places))
        if tag in VOID_TAGS or attributes.endswith("/"):
            return
        if tag == "a" and self.places.get("a"):
            self.end("a")
        _, chrome, article, named, held = self.stack[-1]
        inside = article or tag in ("article", "main")
        if inside and not article:
            held = named
        if tag not in ("html", "body", "article", "main") and attributes:
            chrome = chrome or bool(_HIDDEN.search(attributes))
            # A header inside an article is its own heading, not the page's.
            names = chrome_words(attributes) - ({"header"} if inside else set())
            if names:
                self.containers.append(Container(names, inside, named))
                named = len(self.containers) - 1
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCK_TAGS:
            self.blocks.append(len(self.stack))
        self.silent += tag in SILENT_TAGS
        self.stack.append(Open(tag, chrome or (tag in CHROME_TAGS and not (tag == "header" and inside)), inside, named, held))


def blocks(page: str) -> list[Block]:
    """Blocks with text, in page order."""
    tree, at, size, quotes = Tree(), 0, len(page), True
    unclosed: set[str] = set()  # raw elements that no end tag follows any more
    while at < size:
        less = page.find("<", at)
        if less < 0:
            tree.text(page[at:])
            break
        tree.text(page[at:less])
        at = less + 1
        if page.startswith(("!", "?"), at):
            mark = "-->" if page.startswith("!--", at) else "]]>" if page.startswith("![CDATA[", at) else ">"
            end = page.find(mark, at)
            at = end + len(mark) if end >= 0 else size
            continue
        if not page[at : at + 2].lstrip("/")[:1].isalpha():
            tree.text("<")
            continue
        match = _TAG.match(page, less) if quotes else None
        if match is None:
            # A quote that nothing closes: from here on tags end at the next bracket, and no part is read twice.
            quotes, match = False, _PLAIN_TAG.match(page, less)
            if match is None:
                break
        at, tag = match.end(), match.group(2).lower()
        if match.group(1):
            tree.end(tag)
            continue
        tree.start(tag, match.group(3))
        if tag in RAW_TAGS and tree.stack[-1].tag == tag:
            found = None if tag in unclosed else re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I).search(page, at)
            if found:
                at = found.end()
            else:
                unclosed.add(tag)
                at = size if tag in ("script", "style") else at
            tree.pop(len(tree.stack) - 1)
    for block in tree.found:
        block.text = " ".join("".join(block.parts).split())
    found = [b for b in tree.found if b.text]
    acquit(found, tree.containers)
    return found


def classify(found: list[Block]) -> None:
    """Pass one: good, bad (by its container), linked, or ambiguous: short, or long with few stop words."""
    counts = [stop_words(b.text) for b in found]
    long = [n for b, (n, _) in zip(found, counts, strict=True) if not b.chrome and b.linked <= LINKED * len(b.text) and weight(b.text) >= LONG]
    unknown = bool(long) and not any(long)
    for b, (n, words) in zip(found, counts, strict=True):
        stops = n / max(1, words)
        if b.chrome:
            b.label = "bad"
        elif b.linked > LINKED * len(b.text):
            b.label = "short" if b.article and not b.item else "linked"
        elif unknown and not b.heading:
            b.label = "good" if weight(b.text) >= LONG else "short"
        elif len(b.text) < SHORT or b.heading:
            b.label = "short"
        elif stops >= STOP_HIGH or (stops >= STOP_LOW and len(b.text) >= LONG) or (b.article and len(b.text) >= LONG):
            b.label = "good"
        else:
            b.label = "short" if stops >= STOP_LOW or b.article else "few"


def neighbours(found: list[Block]) -> list[tuple[str | None, int]]:
    """For each block the nearest label before it that density decided, and the characters between."""
    out, last, between = [], None, 0
    for b in found:
        out.append((last, between))
        if b.label in ("good", "linked"):
            last, between = b.label, 0
        else:
            between += len(b.text)
    return out


def inherit(found: list[Block]) -> None:
    """Pass two: ambiguous blocks take the label of their nearest decided neighbours."""
    sides = zip(neighbours(found), neighbours(found[::-1])[::-1], strict=True)
    labels = []
    for b, ((before, back), (after, ahead)) in zip(found, sides, strict=True):
        if b.label not in ("short", "few"):
            labels.append(b.label)
        elif b.article:
            # Within an article only boilerplate that pass one decided is left out.
            labels.append("good")
        elif b.heading:
            labels.append(after or before or "good")
        elif b.label == "few":
            labels.append("linked" if "linked" in (before, after) else "good")
        elif before == after:
            labels.append(before or "good")
        elif None in (before, after):
            labels.append(before or after if b.text.rstrip(QUOTES).endswith(CLOSING) else "linked")
        else:
            labels.append(before if (back, before != "good") < (ahead, after != "good") else after)
    for b, label in zip(found, labels, strict=True):
        b.label = label


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    classify(found)
    inherit(found)
    return " ".join(b.text for b in found if b.label == "good")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars) for every row."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2):
                texts = [main_text(x) for x in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, url_col, html_col).mapInArrow(run, f"{id_col} {kind}, {url_col} string, text string, n_chars bigint")
