"""Sentence units of texts in any language and script, by a finite transducer run over chunks.

A text is a stream of tokens: words, stops, quotes and brackets, blanks, line breaks. A table tells each token's class. The
rules about boundaries (abbreviations, numbers and ordinals, decimals, quotations, sentences that go on, scripts without
blanks or full stops, headings and lists) are compiled into one transition table of at most 256 states: what a gap means
is decided by the state it left behind and the class of the token that comes next. A state holds the kind of line, whether
Greek was written since the unit began, whether a guillemet is open, the kind of word before, and the gap that waits.

Every text is cut into chunks, where the transducer is in one of ``ENTRIES`` whatever came before. A chunk is a function from
these to the state after it and the place where the last unit began; with it come the boundaries, each with the set of entry
states that make it one. Functions are composed in a tree of blocks, one job a level, and the states before each chunk come
back down the tree. So a text is read once, in parallel chunks, and what is moved is some bytes for each boundary.

Units cover all text but the white space between them, so a unit ends where the text before the next one does.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.session import cut, wide

#: Characters of a chunk, about; chunks of a text that stay with the task that read it, the others are spread; chunks, and
#: then blocks, whose functions are composed together. None of them has an influence on the result.
CHUNK_CHARS, STAY, FAN_IN = 1_000, 16, 16

# Abbreviations, told apart by case. What follows the first never begins a sentence, what follows the
# second does unless it is a number, what follows the third does if it begins like a sentence.
BEFORE_MORE = frozenset(
    """Mr Mrs Ms Dr Prof Rev Gen Col Sgt Capt Lt St Mt Gov Sen Rep Hon Messrs vs approx e.g i.e cf viz resp
    M MM Mme Mlle Pr p.ex env av janv févr avr juil Sr Sra Srta Dra Dña aprox p.ej ej ex
    Hr Fr Frau bzw ca vgl ggf evtl inkl zzgl bspw sog z.B d.h u.a o.ä Abk
    т.е т.к напр см ср проф им ул акад г-н г-жа π.χ κ κα κος δρ καθ δηλ βλ د أ م डॉ श्री प्रो पं""".split()
)
BEFORE_NUMBER = frozenset(
    """No Nos Nr Fig Figs Eq Eqs Sec Secs Ch Vol p pp P art Art fig chap vol núm pág págs cap S Abb Kap Bd Abs Tab
    рис стр гл табл п ст № σελ αρ εικ κεφ Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec Okt Dez""".split()
)
MAY_END = frozenset("etc Inc Ltd Co Corp usw ff al Jr Sr a.m p.m U.K U.S U.N E.U EE.UU г гг т.д т.п др κ.λπ κλπ μ.μ π.μ".split())
# German words before an ordinal, and months after one.
BEFORE_ORDINAL = frozenset("der die das dem den des am im vom zum zur bis beim jeder jede jedes ein eine seit ab".split())
MONTHS = frozenset("Januar Jänner Februar März April Mai Juni Juli August September Oktober November Dezember".split())
# Japanese particles that go on after a quotation.
PARTICLES = "とをはがにでものっか"

THAI, LAO = "ก-ฺเ-๎", "ກ-ໄໆ-ໍ"
GREEK = "Ͱ-ͽͿ-Ͽἀ-῿"
STOPS, ASKS, DOTS, SEMIS = "。｡।॥۔።։။។", "!?！？؟", ".．…‥", ";;"
CLOSERS = "\"'”’»›）)\\]】」』〉》〕}"
OPENERS = "\"'“„‚‘”«‹»（(\\[【「『〈《〔{¿¡"


TOKEN = regex.compile(
    "|".join(
        [
            rf"(?P<term>[{STOPS}{ASKS}{DOTS}{SEMIS}]+)",
            rf"(?P<apart>(?<=[{THAI}])\s+(?=[{THAI}])|(?<=[{LAO}])\s+(?=[{LAO}]))",
            r"(?P<line>[^\S\r\n  ]*[\r\n  ]\s*)",
            r"(?P<blank>\s+)",
            rf"(?P<mark>[{CLOSERS}{OPENERS}])",
            rf"(?P<dotted>(?=\w{{1,2}}\.)(?<![^\s\"'“”„«»(\[（])(?:{'|'.join(regex.escape(w).replace('[.]', '.').replace(chr(92) + '.', chr(92) + r'.[^\S\r\n]?') for w in sorted(BEFORE_MORE | MAY_END) if '.' in w)})(?=\.))",
            r"(?P<dash>[—–-](?![—–-]))",
            rf"(?P<code>(?=\p{{Lowercase}}(?:\w*+(?:\(|::|\.\w)|[^\W_]*+_\w))[^\s{STOPS}{ASKS}{DOTS}{SEMIS}{CLOSERS}{OPENERS}]+)",
            rf"(?P<word>[^\s{STOPS}{ASKS}{DOTS}{SEMIS}{CLOSERS}{OPENERS}]+)",
        ]
    )
)
BREAK = regex.compile("\r\n|[\n\r ]|(?P<two> )")
HEADING, BULLET, NUMBER = regex.compile(r"#{1,6}(?!\S)"), regex.compile(r"[-*+•‣◦](?!\S)"), regex.compile(r"[0-9]{1,3}[.)](?!\S)")
HAS_GREEK, LETTERS = regex.compile(f"[{GREEK}]"), regex.compile(r"\w*")
#: Where a chunk may end: between a blank after a word and the next word, or within a word of a script without blanks.
_UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
CUT = regex.compile(rf"(?<=[\p{{L}}\p{{N}}--[{_UNSPACED}]] )(?=[\p{{L}}\p{{N}}--[{_UNSPACED}]])|(?<=[[{_UNSPACED}]&&\p{{L}}])(?=[[{_UNSPACED}]&&\p{{L}}])", regex.V1)

# States: (kind, detail, greek, quote). LINE is a heading or list item; BEGIN the place where a word may begin, with the
# detail if the word before asks for an ordinal; WORD is after a word of that detail; STOP after a stop without a blank;
# GAP after a stop and a blank, QUOTED after a guillemet that stood apart and closed.
LINE, BEGIN, WORD, STOP, GAP, QUOTED = "line", "begin", "word", "stop", "gap", "quoted"
#: What a transition does: give the gap that waits as a boundary, give the token's end as one, let the token's end wait.
GIVE, GIVE_END, WAIT = 1, 2, 4

# Kinds of words as seen from a stop that follows, and from a gap before.
LEFT = ("other", "more", "number", "may end", "ordinal", "digits", "capital", "letter")
RIGHT = ("lower", "code", "upper", "digit", "wide", "caseless", "particle", "comma", "month", "dash", "dashes", "other")
MARKS = ("open", "either", "close", "«", "»")
TERMS = ("dot", "pause", "stop", "stop ask", "ask", "wide ask", "semi", "none")
# What a gap waits for, by the stop: plain ones end unless a small letter follows; the others are named after what goes on.
ABBREVIATIONS = {"number": "number", "may end": "may end", "digits": "digits", "letter": "letter", "more": None, "capital": None, "ordinal digits": None}


def classes() -> list[tuple]:
    """All classes of tokens."""
    words = [("word", left, right, single, greek) for left in LEFT for right in RIGHT for single in (False, True) for greek in (False, True)]
    lines = [("line", n, mark, apart) for n in (1, 2) for mark in ("text", "number", "item") for apart in (False, True)]
    return [*words, *lines, ("blank",), ("apart",), *(("mark", m) for m in MARKS), *(("term", t) for t in TERMS)]


def gap_after(stop: str, closed: bool, greek: bool) -> str | None:
    """The gap that a stop leaves before a blank; None if it ends nothing, whatever follows."""
    if stop == "semi" and not greek or stop.startswith("dot:") and not closed:
        return ABBREVIATIONS[stop[4:]] if stop.startswith("dot:") else None
    if stop == "pause":
        return "closed, asked" if closed else "pause"
    if "ask" in stop:
        return "closed, asked" if closed else "asked"
    return "closed" if closed else "plain"


def ends_gap(gap: str, right: str, single: bool) -> bool:
    """Whether a gap is a boundary before a word."""
    if right in ("comma", "lower") or right == "dashes" and gap.startswith("closed"):
        return False
    if right in ("wide", "caseless", "particle") and gap in ("pause", "closed, asked"):
        return False
    if right == "code" and gap == "may end" or right == "digit" and gap == "number" or right == "month" and gap == "digits":
        return False
    return not (single and gap == "letter")


def ends_unspaced(stop: str, closed: bool, right: str) -> bool:
    """Whether a stop is a boundary before a word that follows without a blank."""
    if right == "comma":
        return False
    if stop in ("stop", "stop ask"):
        return not (closed and right == "particle")
    if stop in ("ask", "wide ask"):
        return not closed and (stop == "wide ask" or right in ("wide", "particle"))
    return False


def step(state: tuple, token: tuple) -> tuple[tuple, int]:
    """The transition: next state, and what is done."""
    kind, detail, greek, quote = state
    what = token[0]
    if what == "mark":
        turned = {"«": True, "»": False}.get(token[1], quote)
    if what == "line":
        _, n, mark, apart = token
        new = (LINE, None, False, quote and n == 1) if mark != "text" else (BEGIN, False, False, quote and n == 1)
        if kind == LINE or n == 2 or mark == "item":
            return new, GIVE_END | (GIVE if kind == GAP else 0)
        if apart:
            return (BEGIN, False, False, quote), GIVE_END
        if kind == GAP:
            return (BEGIN, False, False, quote), GIVE
        what = "blank"  # a line break inside a paragraph is like a blank
    if kind == LINE:
        return (LINE, None, False, turned if what == "mark" else quote), 0

    if kind == QUOTED:
        if what == "blank":
            return (GAP, detail, greek, quote), WAIT
        if what == "mark" and token[1] in ("either", "close"):
            return (QUOTED, detail, greek, quote), WAIT
        kind = GAP
    if kind in (BEGIN, WORD):
        if what == "blank":
            return (BEGIN, detail if kind == BEGIN else detail == "ordinal", greek, quote), 0
        if what == "apart":
            return (BEGIN, False, False, quote), GIVE_END
        if what == "word":
            _, left, right, _, has = token
            left = "other" if kind == WORD or right == "dash" else "ordinal digits" if left == "digits" and detail else left
            return (WORD, left, greek or has, quote), 0
        if what == "mark":
            return (BEGIN, False, greek, turned), 0
        if token[1] == "none":
            return (WORD, "other", greek, quote), 0
        before = f"dot:{detail}" if kind == WORD and token[1] == "dot" and detail in ABBREVIATIONS else token[1]
        return (STOP, (before, False), greek, quote), WAIT

    if kind == STOP:
        stop, closed = detail
        if what in ("blank", "apart"):
            gap = gap_after(stop, closed, greek)
            return ((GAP, gap, greek, quote), WAIT) if gap else ((BEGIN, False, greek, quote), 0)
        if what == "mark" and token[1] in ("either", "close", "»") and stop != "ask opened":
            return (STOP, (stop, True), greek, turned), WAIT
        if what == "mark":
            if stop in ("stop", "stop ask", "wide ask"):
                return (BEGIN, False, False, turned), GIVE
            return ((STOP, ("ask opened", False), greek, turned) if stop == "ask" else (BEGIN, False, greek, turned)), 0
        if what == "term":
            ends = ends_unspaced(stop, closed, "other")
            return (STOP, (token[1], False), greek and not ends, quote), WAIT | (GIVE if ends else 0)
        _, left, right, _, has = token
        ends = right in ("wide", "particle") if stop == "ask opened" else ends_unspaced(stop, closed, right)
        return (WORD, "other", greek and not ends or has, quote), GIVE if ends else 0

    if what in ("blank", "apart"):
        return (GAP, detail, greek, quote), 0
    if what == "mark":
        if token[1] == "»" and quote:
            return (QUOTED, "closed, asked" if detail in ("pause", "asked", "closed, asked") else "closed", greek, False), WAIT
        if token[1] == "close":
            return (WORD, "other", False, turned), GIVE
        return (GAP, detail, greek, quote or token[1] in "«»"), 0
    if what == "term":
        return (STOP, (token[1], False), False, quote), GIVE | WAIT
    _, left, right, single, has = token
    if right == "dash":
        return ((WORD, "other", greek, quote), 0) if detail.startswith("closed") else ((GAP, detail, greek, quote), 0)
    ends = ends_gap(detail, right, single)
    return (WORD, left, greek and not ends or has, quote), GIVE if ends else 0


#: The states in which a chunk may begin.
ENTRIES = [(LINE, None, False, q) for q in (False, True)] + [
    (k, d, g, q) for k, d in ((BEGIN, False), (BEGIN, True), (WORD, "other")) for g in (False, True) for q in (False, True)
]


class Machine:
    """The transition table: for each class a row of next states and one of what is done, by state."""

    def __init__(self) -> None:
        number, todo, self.number_of = {s: i for i, s in enumerate(ENTRIES)}, list(ENTRIES), {c: i for i, c in enumerate(classes())}
        rows: list[list[tuple[int, int]]] = [[] for _ in self.number_of]
        for state in todo:
            for token, i in self.number_of.items():
                new, does = step(state, token)
                if new not in number:
                    number[new] = len(number)
                    todo.append(new)
                rows[i].append((number[new], does))
        assert len(number) <= 256
        self.next = [bytes(r[0] for r in row).ljust(256, b"\0") for row in rows]
        self.does = [bytes(r[1] for r in row).ljust(256, b"\0") for row in rows]
        self.kinds = [s[0] for s in number]
        # A cut within a word leaves its detail of no use. After a text's last chunk no state is of use.
        entry = {s: i for i, s in enumerate(ENTRIES)}
        self.exit = [entry.get((s[0], "other", *s[2:]) if s[0] == WORD else s, 0) for s in number]
        for group, token in (("apart", ("apart",)), ("blank", ("blank",)), ("dash", ("word", "other", "dash", False, False))):
            setattr(self, group, self.number_of[token])
        self.marks = {c: self.number_of["mark", m] for m, cs in zip(MARKS, ("“„‚‘‹（([【「『〈《〔{¿¡", "\"'”", "’›）)]】」』〉》〕}", "«", "»")) for c in cs}
        self.quote = self.number_of["mark", "either"]

    @lru_cache(1 << 16)  # noqa: B019
    def word(self, word: str, single: bool, code: bool) -> int:
        return self.number_of["word", left_kind(word), right_kind(word, code), single, HAS_GREEK.search(word) is not None]

    @lru_cache(1 << 12)  # noqa: B019
    def term(self, term: str) -> int:
        return self.number_of["term", term_kind(term)]

    def line(self, text: str, white: str, end: int, apart: bool) -> int:
        return self.number_of["line", break_count(white), line_kind(text, end), apart]


@lru_cache(1)
def machine() -> Machine:
    return Machine()


def left_kind(word: str) -> str:
    """A word as a stop after it sees it. White space within an abbreviation doesn't matter."""
    whole = "".join(word.split())
    if whole in BEFORE_MORE:
        return "more"
    if whole in MAY_END:
        return "may end"
    if word in BEFORE_NUMBER:
        return "number"
    if word.isdigit():
        return "digits" if len(word) <= 4 else "other"
    if len(word) == 1:
        return "capital" if word.isupper() else "letter"
    return "ordinal" if word.lower() in BEFORE_ORDINAL else "other"


def right_kind(word: str, code: bool) -> str:
    """A word as a gap before it sees it."""
    first = word[0]
    if code:
        return "code"
    if first in "，、；：,:":
        return "comma"
    if first in "—–-":
        return "dashes"
    if first.isalpha() and first.lower() == first.upper():
        if first in PARTICLES:
            return "particle"
        return "caseless" if "؀" <= first <= "๿" or "가" <= first <= "힣" else "wide"
    if first.islower():
        return "lower"
    if LETTERS.match(word)[0] in MONTHS:
        return "month"
    return "digit" if first.isdigit() else "upper" if first.isupper() else "other"


def term_kind(term: str) -> str:
    if set(term) <= set(DOTS):
        return "pause" if len(term) > 1 or term in "…‥" else "dot"
    stop, ask = any(c in STOPS for c in term), any(c in ASKS for c in term)
    if stop or ask:
        return "stop ask" if stop and ask else "stop" if stop else "wide ask" if any(c in "！？" for c in term) else "ask"
    return "semi" if set(term) <= set(SEMIS) else "none"


def line_kind(text: str, at: int) -> str:
    if HEADING.match(text, at) or BULLET.match(text, at):
        return "item"
    return "number" if NUMBER.match(text, at) else "text"


def break_count(white: str) -> int:
    found = list(BREAK.finditer(white))
    return 2 if len(found) > 1 or found[0]["two"] else 1


def tokens(text: str, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """(class, end) of the tokens of text[lo:hi]; the text around it may be looked at."""
    m = machine()
    for t in TOKEN.finditer(text, lo):
        what, end = t.lastgroup, t.end()
        if end > hi:
            if t.start() >= hi:
                return
            end = hi  # a word of a script without blanks that was cut
        if what == "word" or what == "code":
            word = text[t.start() : end] if end - t.start() < 32 else text[t.start() : t.start() + 32]
            if len(word) == 32 and (greek := HAS_GREEK.search(text, t.start(), end)):
                word = word[:31] + greek[0]
            yield m.word(word, end - t.start() == 1 and text[end : end + 1] == ".", what == "code"), end
        elif what == "blank":
            yield m.blank, end
        elif what == "mark":
            c = t[0]
            yield (m.quote if c == "“" and text[t.start() - 1 : t.start()] in (".", "!", "?", "…") else m.marks[c]), end
        elif what == "term":
            yield m.term(t[0]), end
        elif what == "line":
            yield m.line(text, t[0], end, False), end
        elif what == "apart":
            yield (m.line(text, t[0], end, True) if BREAK.search(t[0]) else m.apart), end
        elif what == "dash":
            yield m.dash, end
        else:
            yield m.word(t[0], False, t[0][0].islower() and not any(c.isspace() for c in t[0])), end


def transduce(text: str, lo: int, hi: int, first: bool) -> tuple[list[int], list[int], list[tuple[int, int]]]:
    """A chunk as a function: by entry the state after it and the last place where a unit begins in it, or -1; and the places
    where units begin, each with the set of entries (bits) for which one does. ``first``: the text begins at ``lo``, as after a blank line."""
    m = machine()
    n = len(ENTRIES)
    live, owners, waiting = bytes(range(n)), [[i] for i in range(n)], [-1] * n
    lasts, found = [-1] * n, {}

    def give(i: int, at: int) -> None:
        for entry in owners[i]:
            lasts[entry] = at
        found[at] = found.get(at, 0) | sum(1 << entry for entry in owners[i])

    def merge() -> None:
        nonlocal live, owners, waiting
        together: dict[tuple, list[int]] = {}
        for i, s in enumerate(live):
            together.setdefault((s, waiting[i] if m.kinds[s] in (STOP, GAP, QUOTED) else -1), []).extend(owners[i])
        if len(together) < len(live):
            live, owners, waiting = bytes(s for s, _ in together), list(together.values()), [w for _, w in together]

    stream = tokens(text, lo, hi)
    if first:
        stream = _chain((m.number_of["line", 2, line_kind(text, lo), False], lo), stream)
    for token, end in stream:
        does = live.translate(m.does[token])
        live = live.translate(m.next[token])
        if does.count(0) != len(does):
            for i, d in enumerate(does):
                if d & GIVE:
                    give(i, waiting[i])
                if d & GIVE_END:
                    give(i, end)
                if d & WAIT:
                    waiting[i] = end
        if len(live) > 1:
            merge()
    exits = [0] * n
    for i, s in enumerate(live):
        for entry in owners[i]:
            exits[entry] = m.exit[s]
    return exits, lasts, sorted(found.items())


def _chain(one: tuple[int, int], rest: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    yield one
    yield from rest


def chunk_edges(text: str, chunk_chars: int) -> list[int]:
    """Where the chunks of a text begin and end, without the white space at either end; [] for a blank text."""
    if not text or text.isspace():
        return []
    lo, hi = len(text) - len(text.lstrip()), len(text.rstrip())
    edges = [lo]
    while edges[-1] + chunk_chars < hi and (m := CUT.search(text, edges[-1] + chunk_chars, hi)) and m.start() < hi:
        edges.append(m.start())
    return [*edges, hi]


def _end_before(text: str, at: int) -> int:
    while at > 0 and text[at - 1].isspace():
        at -= 1
    return at


def units(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of each unit of a whole text as one chunk; [] for a null or blank one."""
    edges = chunk_edges(text or "", len(text or "") + 1)
    if not edges:
        return []
    begins = [at for at, _ in transduce(text, *edges, True)[2]]
    return list(zip(begins, [*(_end_before(text, b) for b in begins[1:]), edges[1]]))


def _composed(members: Column) -> tuple[Column, Column]:
    """The function (exits, lasts) of a block from those of its members, in order."""
    start = F.struct(F.sequence(F.lit(0), F.lit(len(ENTRIES) - 1)).alias("exits"), F.array_repeat(F.lit(-1), len(ENTRIES)).alias("lasts"))

    def then(f: Column, g: Column) -> Column:
        exits = F.transform(f["exits"], lambda s: F.get(g["exits"], s))
        lasts = F.zip_with(f["exits"], f["lasts"], lambda s, at: F.greatest(at, F.get(g["lasts"], s)))
        return F.struct(exits.alias("exits"), lasts.alias("lasts"))

    return F.aggregate(members, start, then)


def _entered(members: Column, state: Column, begun: Column) -> Column:
    """The state before each member, and where the unit there began, from those before the block."""

    def then(acc: Column, f: Column) -> Column:
        state, begun = F.get(f["exits"], acc["state"]), F.greatest(acc["begun"], F.get(f["lasts"], acc["state"]))
        return F.struct(state.alias("state"), begun.alias("begun"), F.concat(acc["all"], F.array(F.struct(acc["state"].alias("state"), acc["begun"].alias("begun")))).alias("all"))

    none = F.array().cast("array<struct<state:int,begun:int>>")
    return F.aggregate(members, F.struct(state.alias("state"), begun.alias("begun"), none.alias("all")), then)["all"]


def scan(nodes: DataFrame, rest: tuple[str, ...] = ()) -> DataFrame:
    """``nodes`` (row, at, exits, lasts and ``rest``) with ``state`` and ``begun``: those before each node of its row.

    The functions of ``FAN_IN`` neighbours are composed to that of a block, blocks are scanned in the same way, and what
    comes before a block goes down to its members. A job for each level, of which there are log(nodes) to the base FAN_IN.
    """
    members = F.array_sort(F.collect_list(F.struct("at", "exits", "lasts", *rest)))
    blocks = cut(nodes.groupBy("row", F.floor(F.col("at") / FAN_IN).cast("int").alias("block")).agg(members.alias("members")), "blocks")
    if blocks.agg(F.coalesce(F.max("block"), F.lit(0)).alias("most")).collect()[0].most == 0:
        entered = blocks.select("row", "members", F.lit(0).alias("state"), F.lit(-1).alias("begun"))
    else:
        composed = blocks.select("row", F.col("block").alias("at"), _composed(F.col("members")).alias("f")).select("row", "at", "f.exits", "f.lasts")
        above = scan(composed).select("row", F.col("at").alias("block"), "state", "begun")
        entered = blocks.join(above, ["row", "block"]).select("row", "members", "state", "begun")
    each = entered.withColumn("before", _entered(F.col("members"), F.col("state"), F.col("begun")))
    pairs = each.select("row", F.explode(F.arrays_zip("members", "before")).alias("x"))
    return pairs.select("row", "x.members.*", "x.before.*")


def sentence_units(documents: DataFrame, id_col: str = "doc_id", text: str = "text", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(id, start_pos, end_pos) of each unit of each text, as offsets in code points, the end exclusive.

    All texts are cut into chunks of about ``chunk_chars``, at the next place that ``CUT`` allows; a run without such a place
    stays in one chunk. A null, empty or blank text has no units. Rows that repeat an id give the units of each of them.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    slim = documents.select(F.col(id_col).alias("id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    slim = slim.withColumn("row", F.monotonically_increasing_id())
    ints = pa.list_(pa.int32())
    made = pa.schema([("exits", ints), ("lasts", ints), ("begins", ints), ("ends", ints), ("sets", ints)])

    def functions(texts: list[tuple[str, int, int, int, bool]]) -> list[pa.Array]:
        out = []
        for t, base, lo, hi, first in texts:
            if t is None:
                out.append((None,) * 5)
                continue
            exits, lasts, found = transduce(t, lo - base, hi - base, first)
            begins = [at for at, _ in found]
            out.append((exits, [at + base if at >= 0 else -1 for at in lasts], [b + base for b in begins], [_end_before(t, b) + base for b in begins], [s for _, s in found]))
        return [pa.array([x[i] for x in out], ints) for i in range(5)]

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, near, far = [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                edges = chunk_edges(t, chunk_chars)
                for at, (lo, hi) in enumerate(zip(edges, edges[1:])):
                    stays = at < STAY
                    rows.append((i, at, lo, hi, at == len(edges) - 2))
                    near.append((t if stays else None, 0, lo, hi, at == 0))
                    far.append(None if stays else t[lo - 1 : hi + 1])
            if rows:
                index, at, lo, hi, last = (np.array(x) for x in zip(*rows))
                keep = [batch.column(c).take(pa.array(index)) for c in (0, 2)]
                numbers = [pa.array(x.astype(np.int32)) for x in (at, lo, hi)]
                arrays = [*keep, *numbers, pa.array(last), pa.array(far, pa.string()), *functions(near)]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "row", "at", "lo", "hi", "last", "text", *made.names])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t, lo - 1, lo, hi, False) for t, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("text", "lo", "hi")))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], *functions(texts)], schema=batch.schema)

    columns = f"id {kind}, row bigint, at int, lo int, hi int, last boolean, text string, " + ", ".join(f"{c} array<int>" for c in made.names)
    chunks = cut(slim.mapInArrow(cut_up, columns), "chunks")
    far = wide(chunks.filter(F.col("text").isNotNull()), "row", "at").mapInArrow(spread, columns)
    nodes = chunks.filter(F.col("text").isNull()).unionByName(far).drop("text")
    known = scan(nodes, ("id", "hi", "last", "begins", "ends", "sets"))
    true = lambda c: F.filter(c, lambda _, i: F.get("sets", i).bitwiseAND(F.call_function("shiftleft", F.lit(1), F.col("state"))) != 0)
    begins = F.concat(F.array("begun"), true("begins"))
    ends = F.concat(true("ends"), F.when(F.col("last"), F.array("hi")).otherwise(F.array().cast("array<int>")))
    pairs = known.select("id", F.arrays_zip(F.slice(begins, F.lit(1), F.size(ends)).alias("b"), ends.alias("e")).alias("units"))
    found = pairs.select("id", F.explode("units").alias("u")).select(F.col("id").alias(id_col), F.col("u.b").alias("start_pos"), F.col("u.e").alias("end_pos"))
    return found.filter(F.col("start_pos") >= 0)
