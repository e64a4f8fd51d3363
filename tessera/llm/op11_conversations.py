"""Conversation repair by Knuth's lightest derivations.

A conversation may be kept, changed or cut turn by turn until its roles read ``(s?(ua)+)?``.
Items are places in the conversation together with what may follow there; the facts of a turn are
axioms; each edit is a deduction from an item and a fact.  The weight of an item is its lightest
(cost, audit), an agenda pops items in that order, and every deduction only adds to both, so a popped
item is final.

Conversations are cut into blocks of turns.  A block derives, from each state it may begin in, the
lightest way to each state it may end in; runs of such spans derive longer spans the same way.  So no
task holds more than one block of turns or a few spans, however long a conversation is.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import lru_cache
from itertools import groupby, pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.order import rank_within
from ..session import cut_lineage
from .common import arrow_map

BLOCK = 512  # turns whose edits one agenda derives
FAN = 64     # spans that join into a longer one
BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5  # costs; the last is that of a truncated turn that stays
#: states: nothing yet, after s, after u, after a; state after a turn whose role has this initial
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
ACCEPTED = (0, 3)
EDGES = "array<struct<q: int, r: int, cost: bigint, audit: string>>"
SPAN = f"conv string, block long, blocks long, first string, last string, illegal long, edges {EDGES}"


def lightest(axioms, consequences, goals: frozenset) -> dict:
    """Final weights by Knuth's generalisation of Dijkstra's algorithm, up to the first of ``goals`` (all without any).

    ``axioms`` are (weight, item); ``consequences(item, weight, final)`` yields the (weight, item) of the deductions
    that ``item`` completes, the other antecedent standing in ``final``.
    """
    agenda, final = list(axioms), {}
    heapq.heapify(agenda)
    while agenda:
        weight, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        if item in goals:
            break
        for found in consequences(item, weight, final):
            if found[1] not in final:
                heapq.heappush(agenda, found)
    return final


def _add(weight: tuple, cost: int, audit: str, fact: tuple = (0, "")) -> tuple:
    """Weight of a deduction: antecedents' costs and its own, the audit carried on; never lighter than an antecedent."""
    return weight[0] + fact[0] + cost, weight[1] + audit


def _turn_rules(codes: str):
    """Deductions over turns.  Items: (place, state), and the facts (place, 4) "a turn stands here" and (place, 5) "it may stay"."""
    initial = ["suax"[(ord(c) - 65) // 3] for c in codes]

    def kept(place, state, at, stay):
        own = AFTER.get((state, initial[place]))
        if own is not None:
            yield _add(at, KEEP, "K", stay), (place + 1, own)
        for role in "ua":
            if (state, role) in AFTER:
                yield _add(at, REROLE, "R", stay), (place + 1, AFTER[state, role])

    def consequences(item, weight, final):
        place, state = item
        if state > 3:  # a fact: every item that waits at this place
            for q in range(4):
                if (place, q) in final:
                    at = final[place, q]
                    yield from [(_add(at, DELETE, "D", weight), (place + 1, q))] if state == 4 else kept(place, q, at, weight)
            return
        for role in "ua":
            if (state, role) in AFTER:
                yield _add(weight, INSERT, "I"), (place, AFTER[state, role])
        if (place, 4) in final:
            yield _add(weight, DELETE, "D", final[place, 4]), (place + 1, state)
        if (place, 5) in final:
            yield from kept(place, state, weight, final[place, 5])

    facts = []
    for place, c in enumerate(codes):
        facts.append(((0, ""), (place, 4)))
        fault = (ord(c) - 65) % 3
        if fault != 2:
            facts.append(((CUT_OFF * fault, ""), (place, 5)))
    return facts, consequences


def _span_rules(spans: list):
    """Deductions over spans: an item and the fact that a span leads from its state to another."""
    audit = {(i, q, r): a for i, edges in enumerate(spans) for q, r, _, a in edges}

    def consequences(item, weight, final):
        if len(item) == 3:
            i, q, r = item
            if (i, q) in final:
                yield _add(final[i, q], 0, audit[item], weight), (i + 1, r)
            return
        i, q = item
        for r in range(4):
            if (i, q, r) in final:
                yield _add(weight, 0, audit[i, q, r], final[i, q, r]), (i + 1, r)

    return [((cost, ""), (i, q, r)) for i, edges in enumerate(spans) for q, r, cost, _ in edges], consequences


def _edges(rules, n: int, starts, whole: bool) -> list:
    """(q, r, cost, audit) from each start state; of a whole conversation the lightest accepted one alone."""
    facts, consequences = rules
    out = []
    for q in starts:
        final = lightest([*facts, ((0, ""), (0, q))], consequences, frozenset((n, r) for r in ACCEPTED) if whole else frozenset())
        out += [(q, r, *final[n, r]) for r in (ACCEPTED if whole else range(4)) if (n, r) in final]
    return out


@lru_cache(maxsize=1 << 14)
def _turn_edges(codes: str, first: bool, whole: bool) -> tuple:
    return tuple(_edges(_turn_rules(codes), len(codes), (0,) if first else range(4), whole))


def _illegal(initials) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in pairwise(initials))


def _span_rows(rows: list):
    cols = list(zip(*rows, strict=True)) or [[]] * 7
    edge = pa.struct([("q", pa.int32()), ("r", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(edge)]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                      names=["conv", "block", "blocks", "first", "last", "illegal", "edges"])


def _packed(edges) -> list:
    return [{"q": q, "r": r, "cost": c, "audit": a} for q, r, c, a in edges]


def _block_batches(batches):
    """Each block of turns as a span."""
    for b in batches:
        rows = []
        for conv, block, blocks, codes in zip(*(b.column(c).to_pylist() for c in ("conv", "block", "blocks", "codes")), strict=True):
            roles = ["suax"[(ord(c) - 65) // 3] for c in codes]
            rows.append((conv, block, blocks, roles[0], roles[-1], _illegal(roles), _packed(_turn_edges(codes, block == 0, blocks == 1))))
        yield _span_rows(rows)


def _join_batches(batches):
    """Runs of ``FAN`` spans of a conversation, in order, as one longer span each."""
    rows = (r for b in batches for r in b.to_pylist())
    for (conv, run), some in groupby(rows, lambda r: (r["conv"], r["block"] // FAN)):
        some = list(some)
        blocks = -(-some[0]["blocks"] // FAN)
        spans = [[(e["q"], e["r"], e["cost"], e["audit"]) for e in r["edges"]] for r in some]
        illegal = sum(r["illegal"] for r in some) + sum(_illegal((a["last"], z["first"])) for a, z in pairwise(some))
        edges = _edges(_span_rules(spans), len(spans), (0,) if run == 0 else range(4), blocks == 1)
        yield _span_rows([(conv, run, blocks, some[0]["first"], some[-1]["last"], illegal, _packed(edges))])


def _edit_batches(batches):
    """The edits of each audit, one row each but for deletions: the turn they apply to, their place after them, a given role."""
    names = ["conv", "place", "at", "edit", "given"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    for b in batches:
        out = [[] for _ in names]
        for conv, audit in zip(b.column("conv").to_pylist(), b.column("audit").to_pylist(), strict=True):
            place, at = 0, 0
            system = (len(audit) - audit.count("D")) % 2
            for edit in audit:
                if edit != "D":
                    for col, x in zip(out, (conv, None if edit == "I" else place, at, edit, None if edit == "K" else ("user", "assistant")[(at - system) % 2]), strict=True):
                        col.append(x)
                    at += 1
                place += edit != "I"
                if len(out[0]) >= 1 << 16:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)
                    out = [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)


def _digest_batches(batches):
    """SHA-256 of each conversation's ``role:text`` lines; rows come sorted, and only the hash of the lines so far is held."""
    last, state, out = None, None, ([], [])
    for b in batches:
        for conv, role, text in zip(*(b.column(c).to_pylist() for c in ("conv", "role", "text")), strict=True):
            if conv != last:
                if state is not None:
                    out[0].append(last)
                    out[1].append(state.hexdigest())
                last, state = conv, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in out], names=["conv", "repaired_sha256"])
            out = ([], [])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([state.hexdigest()])], names=["conv", "repaired_sha256"])


def key_of(conv: Column) -> Column:
    """A conversation's id as text that also tells null from the empty text."""
    return F.when(conv.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), conv.cast("string")))


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) damaged by crc32 of ``conv_id:turn``, modulo 20, a null counting as one space.

    0 drops the row, 1 empties its text, 2 takes out ``.!?``, 3 repeats it, 4 sets its role to user.  Null roles
    and texts become one space.
    """
    blank = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    out = rows.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
                      F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), kind.alias("__kind"))
    return out.where("__kind != 0").withColumn("__copy", F.explode(F.when(F.col("__kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("__kind", "__copy")


def diagnose(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their place (conv, conv_id, turn, role, text, place, size), and the initial and first fault at each place.

    ``rows``: conv_id, turn, role, text; null roles and texts count as one space, a null conv_id is a conversation.
    Turns stand in the order of turn, nulls first; equal turns by role and text (their first 64 characters, then a
    hash).  Rows may come from files or a cut table: ties of equal rows are numbered as they are read.
    Faults: ``blank`` (nothing but white space), ``duplicate`` (role and text stood earlier), ``truncated`` (last
    character but white space not one of ``.!?``), else null.
    """
    blank = F.lit(" ")
    one = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    one = one.withColumn("conv", key_of(F.col("conv_id"))).withColumn("same", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    one = one.withColumn("__r", F.left("role", F.lit(64))).withColumn("__t", F.left("text", F.lit(64))).withColumn("__n", F.monotonically_increasing_id())
    ranked = cut_lineage(rank_within(one, ["conv"], ["turn", "__r", "__t", "same", "__n"], "place", size_name="size").drop("__r", "__t", "__n"))
    # the first of equal turns, known by its place, which no two turns of a conversation share: a key without hot values
    first = ranked.groupBy("conv", "same").agg(F.min("place").alias("place")).select("conv", "place", F.lit(True).alias("new"))
    end = F.rtrim("text", F.lit(BLANKS))
    fault = (F.when(end == "", F.lit("blank")).when(F.col("new").isNull(), F.lit("duplicate"))
             .when(~F.right(end, F.lit(1)).isin(".", "!", "?"), F.lit("truncated")))
    found = ranked.select("conv", "place", "size", "role", end.alias("text")).join(first, ["conv", "place"], "left")
    return ranked.drop("same"), found.select("conv", "place", "size", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"))


def derive(found: DataFrame) -> DataFrame:
    """conv, cost, audit, illegal of each conversation: the lightest repair, and adjacent roles that may not follow each other.

    The edits are K(eep), R(erole), D(elete) and I(nsert); ``found`` (conv, place, size, initial, fault) comes from
    ``diagnose``.  A role that starts with none of s, u, a (an empty one too) can be changed or deleted, not kept.
    """
    kind = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    bad = F.when(F.col("fault") == "truncated", 1).when(F.col("fault").isNotNull(), 2).otherwise(0)
    code = F.char(F.lit(65) + kind * 3 + bad)
    block = F.floor(F.col("place") / BLOCK).alias("block")
    turns = F.array_sort(F.collect_list(F.struct("place", code.alias("code"))))
    blocks = found.groupBy("conv", block).agg(turns.alias("turns"), F.ceil(F.first("size") / BLOCK).alias("blocks"))
    blocks = blocks.select("conv", "block", "blocks", F.array_join(F.transform("turns", lambda t: t["code"]), "").alias("codes"))
    spans = cut_lineage(arrow_map(blocks, _block_batches, SPAN))
    done = spans.where("blocks = 1")
    spans = spans.where("blocks > 1")
    while not spans.isEmpty():
        runs = spans.repartition("conv", F.expr(f"block div {FAN}")).sortWithinPartitions("conv", "block")
        spans = cut_lineage(arrow_map(runs, _join_batches, SPAN))
        done = done.unionByName(spans.where("blocks = 1"))
        spans = spans.where("blocks > 1")
    best = F.array_min(F.transform("edges", lambda e: F.struct(e["cost"].alias("cost"), e["audit"].alias("audit"))))
    return done.select("conv", "illegal", best.alias("best")).select("conv", "best.cost", "best.audit", "illegal")


def apply_edits(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired turns: conv, conv_id, at (from 0), edit, role, text; inserted ones have an empty text."""
    edits = arrow_map(plans.select("conv", "audit"), _edit_batches, "conv string, place long, at long, edit string, given string")
    kind = turns.schema["conv_id"].dataType
    out = edits.join(turns.select("conv", "place", "role", "text"), ["conv", "place"], "left")
    conv_id = F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).cast(kind).alias("conv_id")
    return out.select("conv", conv_id, "at", "edit", F.coalesce("given", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repaired turns of ``rows`` (conv_id, turn, role, text), and one row per conversation.

    Turns: conv, conv_id, at, edit, role, text.  Conversations: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit.  ``gaps``: turn numbers missing between the least and the largest.  Other columns are left out.
    """
    turns, found = diagnose(rows)
    found = cut_lineage(found)
    plans = cut_lineage(derive(found))
    faults = found.groupBy("conv").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    # distinct turns first, so that a hot conversation is counted in parts
    numbers = turns.groupBy("conv", "conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv", "conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    report = numbers.join(faults, "conv").join(plans, "conv")
    return apply_edits(turns, plans), report.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: of the ``role:text`` lines in order.

    A hash of a whole conversation is a chain: one task reads its lines, sorted, and holds none of them.
    """
    lines = repaired.select("conv", "at", "role", "text").repartition("conv").sortWithinPartitions("conv", "at")
    kind = repaired.schema["conv_id"].dataType
    out = arrow_map(lines.drop("at"), _digest_batches, "conv string, repaired_sha256 string")
    return out.select(F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).cast(kind).alias("conv_id"), "repaired_sha256")


def drill(rows: DataFrame) -> DataFrame:
    """Damages ``rows``, repairs them and returns one row per original conv_id.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.  Conversations that lose all
    their turns have zeros, an empty audit and the hash of the empty text; an empty table gives an empty result.
    """
    turns, report = repair(damage(rows))
    report = report.withColumn("conv", key_of(F.col("conv_id"))).drop("conv_id")
    sums = digests(turns).withColumn("conv", key_of(F.col("conv_id"))).drop("conv_id")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    out = rows.select("conv_id").distinct().withColumn("conv", key_of(F.col("conv_id"))).join(report, "conv", "left").join(sums, "conv", "left")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
