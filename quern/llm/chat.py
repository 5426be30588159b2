"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to one string. Where a turn lies in the output
is found by rendering successive prefixes of the conversation and comparing consecutive outputs; where its
text lies in its span, by rendering the same prefix with two probe texts and comparing those. A template
whose output for a longer prefix does not begin with its output for the shorter one rewrites history; the
turn at which that shows is reported, and no spans are given from there on.

How it runs. Rows are dealt by conversation and sorted inside the partition by Spark, which spills; a task then walks
over them. It holds the turns a template can look back on: all of a conversation's where the template declares nothing,
as the built-in one does, and a few outputs of them.

Defined results:
- A null role or text is empty. Turns are ordered by turn number (nulls last), then role, then text;
  repeated rows are turns of their own. Rows without a conversation id form one conversation.
- An empty table gives an empty result. Other columns are never read, whatever their names.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_columns, whole

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# The control strings of the template and what stands for them inside texts. The escapes hold none of them.
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = {"\\": "\\\\", "###": "\\h", "</turn>": "\\c"}
ROLE_ESCAPES = ESCAPES | {": ": "\\d"}


def escape(text: str, escapes: dict[str, str] = ESCAPES) -> str:
    for plain, stand_in in escapes.items():
        text = text.replace(plain, stand_in)
    return text


def unescape(text: str, escapes: dict[str, str] = ESCAPES) -> str:
    back = {stand_in[1]: plain for plain, stand_in in escapes.items()}
    head, *rest = text.split("\\")
    out, literal = [head], False
    for part in rest:
        if literal:  # the text between two backslashes that were one
            out.append(part)
            literal = False
        elif part == "":  # an escaped backslash: the next part is ordinary text
            out.append("\\")
            literal = True
        else:
            out.append(back[part[0]] + part[1:])
    return "".join(out)


def marked(turns: list[Turn]) -> str:
    """The built-in template: every turn as ``### role: text</turn>`` and a line end."""
    return "".join(f"{OPEN}{escape(role, ROLE_ESCAPES)}{MIDDLE}{escape(text)}{CLOSE}" for role, text in turns)


def parse(formatted: str) -> list[Turn]:
    """The turns of an output of :func:`marked`."""
    turns = []
    for piece in formatted.split(CLOSE)[:-1]:
        role, _, text = piece.removeprefix(OPEN).partition(MIDDLE)
        turns.append((unescape(role, ROLE_ESCAPES), unescape(text)))
    return turns


def _common(a: str, b: str) -> int:
    return len(os.path.commonprefix((a, b)))


class Renderer:
    """Locates the turns of one conversation after the other, one turn at a time.

    ``looks_back``: how many turns before a turn the template's output for it depends on; None: all of them. Then every
    prefix is rendered whole, and the places of texts are probed for every turn.
    """

    def __init__(self, template: Template, looks_back: int | None):
        self.template, self.looks_back = template, looks_back
        self.edges: dict[tuple[str, bool], tuple[str, str]] = {}
        self.begin()

    def begin(self) -> None:
        self.turns: list[Turn] = []
        self.before = ""  # what the template writes before any turn belongs to the first
        self.count, self.at, self.rewrites = 0, 0, False

    def _edges(self, role: str) -> tuple[str, str]:
        """What the template puts before and after a text in this place."""
        place = (role, self.count == 0)
        if self.looks_back != 0 or place not in self.edges:
            one, other = (self.template([*self.turns, (role, probe)])[len(self.before) :] for probe in ("a", "b"))
            edges = one[: _common(one, other)], one[len(one) - _common(one[::-1], other[::-1]) :]
            if self.looks_back != 0 or len(self.edges) > 10_000:  # roles are few; where they are not, none is kept
                return edges
            self.edges[place] = edges
        return self.edges[place]

    def add(self, turn: Turn) -> tuple[str | None, int | None, int | None, int | None, int | None, bool]:
        """The turn's part of the output, its start and end there, its text's start and end, and whether history changed."""
        after = self.template([*self.turns, turn])
        if self.rewrites or not after.startswith(self.before):
            # Nothing has a place any more in an output that changes behind one's back.
            self.rewrites, self.count = True, self.count + 1
            return None, None, None, None, None, True
        piece = after[len(self.before) :]
        head, tail = self._edges(turn[0])
        start = self.at
        text_start = text_end = None
        if piece.startswith(head) and piece.endswith(tail) and len(piece) >= len(head) + len(tail):
            text_start, text_end = start + len(head), start + len(piece) - len(tail)
        self.turns.append(turn)
        self.before, self.count, self.at = after, self.count + 1, start + len(piece)
        if self.looks_back is not None and len(self.turns) > self.looks_back:
            self.turns = self.turns[len(self.turns) - self.looks_back :]
            self.before = self.template(self.turns) if self.turns else ""
        return piece, start, self.at, text_start, text_end, False


SPANS = (
    "turn_number bigint, role string, formatted string, start bigint, end bigint,"
    " text_start bigint, text_end bigint, rewrites boolean"
)


def format_turns(
    turns: DataFrame,
    template: Template = marked,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    looks_back: int | None = None,
) -> DataFrame:
    """One row per turn: its place in the conversation's output and the place of its text there, in code points.

    ``template`` is any function from turns to text. Unless it says otherwise, every prefix of a conversation is rendered
    whole and compared with the one before, so that a template that changes what it wrote is found out at
    whatever turn that happens, at a cost that grows with the square of the number of turns. ``looks_back``, given here
    or as an attribute of the template, declares that its output for a turn depends on so many turns before it only and
    that it never rewrites; then so many are rendered per turn.

    The rows of a conversation come one after the other in the order of its turns. The output of a
    conversation is the concatenation of its ``formatted`` pieces.
    """
    kind = turns.schema[conversation].dataType.simpleString()
    dealt = (
        turns.select(
            F.col(conversation).alias("c"), F.col(turn).alias("t"), whole(role).alias("r"), whole(text).alias("x")
        )
        .repartition("c")
        .sortWithinPartitions("c", F.col("t").asc_nulls_last(), "r", "x")
        .select("c", "r", "x")
    )

    def run(batches: Iterator[list]) -> Iterator[list]:
        back = looks_back if looks_back is not None else getattr(template, "looks_back", None)
        renderer, current = Renderer(template, back), None
        for columns in batches:
            ids, roles, texts = (c.to_pylist() for c in columns)
            rows = []
            for conv, who, what in zip(ids, roles, texts, strict=True):
                if (conv,) != current:
                    renderer.begin()
                    current = (conv,)
                number = renderer.count
                piece, start, end, text_start, text_end, rewrites = renderer.add((who, what))
                rows.append((conv, number, who, piece, start, end, text_start, text_end, rewrites))
            if rows:
                yield list(zip(*rows, strict=True))

    return map_columns(dealt, run, f"`{conversation}` {kind}, {SPANS}")


def read_back(spans: DataFrame, conversation: str = "conv_id", trained: str = "assistant") -> DataFrame:
    """Digests per conversation, parsed from what :func:`format_turns` wrote with the built-in template.

    The rows must come as that function gives them. A task holds one turn at a time.
    """
    kind = spans.schema[conversation].dataType.simpleString()

    def run(batches: Iterator[list]) -> Iterator[list]:
        current, state = None, None

        def close() -> tuple:
            conv, (n, every, chars, loss, formatted) = current[0], state
            return conv, n, every.hexdigest(), chars, loss.hexdigest(), formatted

        for ids, pieces, starts, text_starts, text_ends in batches:
            rows = []
            columns = (c.to_pylist() for c in (ids, pieces, starts, text_starts, text_ends))
            for conv, piece, start, text_start, text_end in zip(*columns, strict=True):
                if (conv,) != current:
                    if current is not None:
                        rows.append(close())
                    current, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if role == trained:
                        under_mask = unescape(piece[text_start - start : text_end - start])
                        state[2] += len(under_mask)
                        state[3].update(under_mask.encode())
                state[4] += len(piece)
            if rows:
                yield list(zip(*rows, strict=True))
        if current is not None:
            yield [[value] for value in close()]

    schema = (
        f"`{conversation}` {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
        " formatted_chars bigint"
    )
    return map_columns(spans.select(conversation, "formatted", "start", "text_start", "text_end"), run, schema)
