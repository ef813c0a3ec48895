"""Chat formatting by quotation linking.

The lines of a message carry quote marks (``>``), one for each level. A message
is cut into passages, runs of lines of one level; its own words are those of
level 0 without attribution lines ("... wrote:"). Each quoted passage is
normalised (case, punctuation and white space do not count) and hashed, and the
hashes are joined to the earliest message of the conversation that holds the
passage among its own words, as a whole, a paragraph or a line. The shallowest
passage that finds an earlier message gives the message that is answered; if
none does, a whole passage may still match line by line. Passages of one or two
words recur by chance: quoted whole, they are linked to the nearest earlier message
that is nothing else.

Answers form trees; pointer jumping finds each message's thread in as many
rounds as the logarithm of its depth. A message never precedes what it answers,
so (thread, turn) is the reply order. Messages stay rows, so a conversation of
any length is never gathered in one task.

Defined cases: null texts are empty messages; a null role is kept as null; rows
with a null conversation or turn stay, answer nothing and form threads of their
own; rows that repeat a turn are one message for links, and each stays; a quote
of nothing in the conversation links nothing; a message that quotes itself or a
later one is not linked to it; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siglake.llm.common import chunked, staged
from siglake.session import cut_lineage

_MARKS = re.compile(r"^[ \t]*((?:>[ \t]?)+)")
_WROTE = re.compile(r"(?:\bwrote|\ba écrit|\bschrieb|\bescribió)\s*:\s*$", re.I)
_WORD = re.compile(r"\w+")
MIN_WORDS = 3            # shorter passages match whole messages only, the nearest one: they recur by chance


def passages(text: str) -> list[tuple[int, list[str]]]:
    """Runs of lines of one quote level: (level, lines without marks)."""
    out: list[tuple[int, list[str]]] = []
    for line in text.split("\n"):
        m = _MARKS.match(line)
        level, rest = (m[1].count(">"), line[m.end():]) if m else (0, line)
        if out and out[-1][0] == level:
            out[-1][1].append(rest)
        else:
            out.append((level, [rest]))
    return out


def own_text(parts: list[tuple[int, list[str]]]) -> str:
    """The message without its quotes and the attribution lines above them."""
    lines: list[str] = []
    for i, (level, own) in enumerate(parts):
        if level == 0:
            if i + 1 < len(parts):
                last = len(own) - 1
                while last >= 0 and not own[last].strip():
                    last -= 1
                if last >= 0 and _WROTE.search(own[last]):
                    own = own[:last]
            lines += own
    return "\n".join(lines).strip()


def _key(text: str) -> int | None:
    words = _WORD.findall(text.lower())
    return xxhash.xxh64_intdigest(" ".join(words)) - (1 << 63) if len(words) >= MIN_WORDS else None


def _short(text: str) -> int | None:
    """The hash of a whole text of fewer than MIN_WORDS words."""
    words = _WORD.findall(text.lower())
    return xxhash.xxh64_intdigest(" ".join(words), seed=1) - (1 << 63) if 0 < len(words) < MIN_WORDS else None


def _parts_of(text: str) -> set[int]:
    """Hashes of a text as a whole, of its paragraphs and of its lines."""
    pieces = [text, *re.split(r"\n\s*\n", text), *text.split("\n")]
    return {k for k in map(_key, pieces) if k is not None}


_PARSED = ("conv_id bigint, turn bigint, role string, text string, n_quotes int, max_level int, "
           "held array<bigint>, short bigint, quoted array<struct<key: bigint, level: int, whole: boolean, short: boolean>>")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    quoted_type = pa.list_(pa.struct([("key", pa.int64()), ("level", pa.int32()), ("whole", pa.bool_()),
                                      ("short", pa.bool_())]))
    for b in chunked(batches, 2 << 20):
        text, n, deep, held, short, quoted = [], [], [], [], [], []
        for t in b.column(3).to_pylist():
            parts = passages(t or "")
            own = own_text(parts)
            quotes = [(level, "\n".join(lines)) for level, lines in parts if level]
            found: dict[tuple[int, bool, bool], int] = {}
            for level, q in quotes:
                for k, whole, brief in [(_key(q), True, False), (_short(q), True, True), *((k, False, False) for k in _parts_of(q))]:
                    if k is not None:
                        found[k, whole, brief] = min(level, found.get((k, whole, brief), level))
            text.append(own)
            n.append(len(quotes))
            deep.append(max((level for level, _ in quotes), default=0))
            held.append(sorted(_parts_of(own)))
            short.append(_short(own))
            quoted.append([{"key": k, "level": lv, "whole": w, "short": brief} for (k, w, brief), lv in sorted(found.items())])
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), pa.array(text, pa.string()), pa.array(n, pa.int32()),
             pa.array(deep, pa.int32()), pa.array(held, pa.list_(pa.int64())), pa.array(short, pa.int64()),
             pa.array(quoted, quoted_type)],
            names=["conv_id", "turn", "role", "text", "n_quotes", "max_level", "held", "short", "quoted"])


def parse(messages: DataFrame) -> DataFrame:
    four = messages.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
                           F.col("role").cast("string"), F.col("text").cast("string"))
    return four.mapInArrow(_parse, _PARSED)


def reply_links(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to): the message that each quoting message answers."""
    known = parsed.where("conv_id is not null and turn is not null")
    quoted = known.where("n_quotes > 0").select("conv_id", "turn", F.explode("quoted").alias("q")).select(
        "conv_id", "turn", F.col("q.key").alias("key"), F.col("q.level").alias("level"), F.col("q.whole").alias("whole"),
        F.col("q.short").alias("short"))
    asked = quoted.where("not short").drop("short")
    # only hashes that some message of the conversation quotes are looked for, and one row for each remains
    wanted = asked.select("conv_id", "key").distinct()
    origin = (known.select("conv_id", "turn", F.explode("held").alias("key"))
              .groupBy("conv_id", "key").agg(F.min("turn").alias("origin")).join(wanted, ["conv_id", "key"], "left_semi"))
    found = asked.join(origin, ["conv_id", "key"]).where("origin < turn")
    # short messages and their quotes in one order: a quote sees the message last before it
    both = known.where("short is not null").select("conv_id", "turn", F.col("short").alias("key"), F.lit(None).cast("int").alias(
        "level"), F.col("turn").alias("held")).union(quoted.where("short").select(
            "conv_id", "turn", "key", "level", F.lit(None).cast("bigint").alias("held")))
    order = Window.partitionBy("conv_id", "key").orderBy("turn", F.col("held").isNotNull())
    nearest = F.last("held", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    brief = both.withColumn("origin", nearest).where("held is null and origin < turn").select(
        "conv_id", "key", "turn", "level", F.lit(True).alias("whole"), "origin")
    found = found.select(*brief.columns).union(brief)
    best = F.min(F.struct((~F.col("whole")).alias("part"), "level", (-F.col("origin")).alias("later")))
    return found.groupBy("conv_id", "turn").agg(best.alias("b")).select(
        "conv_id", "turn", (-F.col("b.later")).alias("reply_to"))


def threads(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(conv_id, turn, thread, depth): the first message of each answering message's tree."""
    at = cut_lineage(links.select("conv_id", "turn", F.col("reply_to").alias("thread"), F.lit(1).alias("depth")))
    for _ in range(max_rounds):
        up = at.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("above"),
                       F.col("depth").alias("more"))
        step = at.join(up, ["conv_id", "thread"], "left")
        moved = cut_lineage(step.select("conv_id", "turn", F.coalesce("above", "thread").alias("thread"),
                                        (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                                        F.col("above").isNotNull().alias("moved")))
        at = moved.drop("moved")
        if moved.where("moved").limit(1).count() == 0:
            return at
    raise RuntimeError(f"threads deeper than 2^{max_rounds}")


def link_quotations(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (without quotes), n_quotes, max_level, reply_to, thread, depth.

    ``ORDER BY conv_id, thread, turn`` is the reply order.
    """
    parsed = staged(parse(messages), "quotes")
    links = staged(reply_links(parsed), "replies")
    if links.limit(1).count():
        tree = links.join(threads(links), ["conv_id", "turn"])
    else:
        tree = links.select("*", F.col("reply_to").alias("thread"), F.lit(0).alias("depth"))
    rows = parsed.drop("held", "short", "quoted")
    out = rows.join(tree, ["conv_id", "turn"], "left")
    return out.select("conv_id", "turn", "role", "text", "n_quotes", "max_level", "reply_to",
                      F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"))


def quoting(messages: DataFrame) -> DataFrame:
    """``messages`` as mail programs would send them: each quotes the one before it in its conversation, whole.

    Every third message also quotes the one before that, a level deeper. Columns:
    conv_id, turn, role, text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = messages.select("conv_id", "turn", "role", text.alias("text")).select(
        "*", F.lag("text").over(order).alias("one"), F.lag("text", 2).over(order).alias("two"),
        F.row_number().over(order).alias("n"))

    def quote(name: str, mark: str) -> Column:
        return F.concat(F.lit(mark), F.replace(F.col(name), F.lit("\n"), F.lit("\n" + mark)), F.lit("\n"))

    deeper = F.when(F.col("two").isNotNull() & (F.col("n") % 3 == 0), quote("two", "> > ")).otherwise("")
    whole = F.concat(deeper, quote("one", "> "), F.lit("\n"), F.col("text"))
    return rows.select("conv_id", "turn", "role", F.when(F.col("one").isNull(), F.col("text")).otherwise(whole).alias("text"))


def chat_rows(linked: DataFrame) -> DataFrame:
    """One formatted chat message per row: ``<|role|>`` header and text, with its place in the reply order."""
    header = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"))
    return linked.select("conv_id", "thread", "turn", "reply_to", "depth", F.concat(header, "text").alias("message"))
