"""Document fingerprints by winnowing, in SQL functions only.

Every ``GRAM`` bytes of a text in a row (UTF-8) have a hash: CRC-32, the Rabin fingerprint over GF(2), of each position
of the rolling window. Of each ``WINDOW`` neighbouring hashes the least is chosen, of equal ones the rightmost, and
the chosen ones with their positions are the fingerprint. So two texts that share ``GRAM + WINDOW - 1`` bytes share a
chosen hash, at the same place of the shared bytes, and nothing shorter than ``GRAM`` bytes is ever matched.

A hash and its position are one number, so a window's minimum settles ties as well. Minima of ``WINDOW`` numbers take
passes of four, four and two over all positions. Long texts are worked on in pieces of ``PIECE`` windows, one after the
other in their row, so intermediate arrays stay small.

A text with fewer hashes than a window has one window; one shorter than ``GRAM`` bytes is one gram. A null text is an
empty one, whose fingerprint is empty. Two empty fingerprints have likeness 1, an empty and another one 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sprintmart.llm.stored import stored

GRAM = 20
#: The passes below make 4 * 4 * 2.
WINDOW = 32

PIECE = 4096

#: Documents of a part when they are put in order.
PART_ROWS = 200_000

#: Position bits of a number; a text has fewer bytes.
_POSITION = 2**31 - 1


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` worked out once; a column would be put in place of its name, and worked out at each use."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _least(array: str, stride: int, ways: int) -> str:
    """Minimum over every ``ways`` values with a stride, at the first one's place."""
    others = ", ".join(f"get({array}, i + {stride * k})" for k in range(1, ways))
    return f"transform({array}, (x, i) -> least(x, {others}))"


def _chosen(data: str) -> str:
    """SQL for the chosen hashes of a binary: array<bigint> of position * 2**32 + hash, by position."""
    number = f"shiftleft(crc32(substring(b, i + 1, {GRAM})), 31) | ({_POSITION} - i)"
    hashes = f"transform(sequence(p * {PIECE}, least(p * {PIECE} + {PIECE + WINDOW - 2}, g - 1)), i -> {number})"
    minima = _let(_least("h", 1, 4), "m4", _let(_least("m4", 4, 4), "m16", _least("m16", 16, 2)))
    # Bound once, as the result is both cut and measured.
    minima = _let(minima, "m", f"slice(m, 1, greatest(size(m) - {WINDOW - 1}, 1))")
    piece = _let(hashes, "h", f"array_distinct({minima})")
    many = f"flatten(transform(sequence(0, greatest(g - {WINDOW}, 0) div {PIECE}), p -> {piece}))"
    spread = f"shiftleft({_POSITION} - (v & {_POSITION}), 32) | shiftright(v, 31)"
    found = f"transform(array_distinct({many}), v -> {spread})"
    grams = _let(f"octet_length(b) - {GRAM - 1}", "g", f"if(g > 0, {found}, if(octet_length(b) > 0, array(crc32(b)), array()))")
    return _let(data, "b", grams)


def _hashes(marks: str) -> str:
    return f"transform({marks}, v -> cast(if((v & 4294967295) > 2147483647, (v & 4294967295) - 4294967296, v & 4294967295) as int))"


def _data(text: str) -> str:
    return f"cast(coalesce({text}, '') as binary)"


def fingerprint(text: str) -> Column:
    """The fingerprint of a column of texts: array<struct<hash, position>>, by position in bytes."""
    return F.expr(
        f"transform({_chosen(_data(text))}, v -> named_struct('hash', v & 4294967295, 'position', shiftright(v, 32)))"
    )


def matches(x: str, y: str) -> Column:
    """Position pairs of the hashes that two fingerprints share, each hash of x with its first place in y."""
    return F.expr(f"""
        transform(filter({x}, a -> exists({y}, b -> b.hash = a.hash)),
                  a -> named_struct('x', a.position, 'y', try_element_at(filter({y}, b -> b.hash = a.hash), 1).position))
    """)


def likeness(x: str, y: str) -> Column:
    """Jaccard similarity of two arrays of hashes."""
    return F.expr(
        f"if(size({x}) = 0 and size({y}) = 0, 1D,"
        f" size(array_intersect({x}, {y})) / cast(greatest(size(array_union({x}, {y})), 1) as double))"
    )


def as_text(hashes: str) -> Column:
    """Hashes in order of their positions, eight hexadecimal digits each."""
    return F.expr(f"array_join(transform({hashes}, h -> lpad(lower(hex(cast(h as bigint) & 4294967295)), 8, '0')), '')")


def next_documents(keys: DataFrame) -> DataFrame:
    """(key, next): for each distinct row (doc_id, key) the key of the one that follows by falling doc_id, null ids last,
    ties by falling key; after the last one the first. Rows are cut into ranges; only their first rows meet."""
    order = [F.desc_nulls_last("doc_id"), F.desc("key")]
    parts = max(1, -(-keys.count() // PART_ROWS))
    ranged = keys.repartitionByRange(parts, *order).select("doc_id", "key", F.spark_partition_id().alias("part"))
    rows = stored(ranged, "ordered")
    first = rows.groupBy("part").agg(
        F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "key")).alias("f")
    )
    # One row a part of PART_ROWS documents.
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = first.select(
        "part", F.coalesce(F.lead("f").over(Window.orderBy("part")), F.first("f").over(whole)).alias("following")
    )
    inside = rows.withColumn("next", F.lead("key").over(Window.partitionBy("part").orderBy(*order)))
    return inside.join(following, "part").select("key", F.coalesce("next", "following.key").alias("next"))


#: Bytes of a window, and how much of a text is worked on beside a seam.
_REACH = GRAM + WINDOW - 1
_BESIDE = 2 * (_REACH + 1)

_KEPT = "substring(text, 1, char_length(text) - char_length(text) div 3)"


def _edited_hashes() -> str:
    """SQL for the hashes of the edited text. Windows inside the kept part are those of the text, windows inside the
    new part those of the next document; only windows across the seam and at the end are worked out.

    With c bytes kept and l new ones: places up to c - reach are the text's own, those up to c + WINDOW - 2 come from
    the bytes beside the seam, those up to c + l - reach from the next document, the rest from the last bytes."""
    seam = (
        f"concat(substring(k, c - least(c, {_BESIDE}) + 1), substring(s, 1, least(octet_length(s), {_BESIDE})))"
    )
    low = f"if(c > {_BESIDE}, {_BESIDE - _REACH}, -1)"
    high = f"if(octet_length(s) > {_BESIDE}, least(c, {_BESIDE}) + {WINDOW - 2}, {_POSITION})"
    beside = f"filter({_chosen(seam)}, v -> shiftright(v, 32) > {low} and shiftright(v, 32) <= {high})"
    end = f"filter({_chosen(f'substring(s, octet_length(s) - {_BESIDE - 1})')}, v -> shiftright(v, 32) > {_BESIDE - _REACH})"
    whole = (
        f"concat(slice(hashes, 2, element_at(hashes, 1)), {_hashes(beside)}, slice(next_hashes, first_given + 2, n_given),"
        f" if(octet_length(s) > {_BESIDE}, {_hashes(end)}, cast(array() as array<int>)))"
    )
    kept = _let(f"cast({_KEPT} as binary)", "k", _let("octet_length(k)", "c", whole))
    return _let("cast(start as binary)", "s", kept)


def edited_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: ``doc_id``, ``n_chars``, the ``edited`` text (its last third, rounded down, replaced by as many
    characters from the start of the next document, or all it has), ``next_id``, and the chosen hashes of the text
    (``hashes``, and ``gaps``: from one position to the next), of the edited text (``edited_hashes``) and of the next
    document (``next_hashes``).

    Rows equal in id and text are one document among the others, and each is returned. A document that is alone
    is its own next one. Each text is fingerprinted once and shuffled once: both joins read the same exchange, which
    takes that all columns of it are asked for.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.select(
        "doc_id", "text", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), "text")).alias("key")
    )
    listed = stored(rows.select("doc_id", "key", F.char_length("text").alias("n")).distinct(), "documents")
    links = listed.select("key", F.expr("cast(n div 3 as int)").alias("take")).join(
        next_documents(listed.select("doc_id", "key")), "key"
    )
    # The number of hashes whose windows lie in the kept part goes in front of the hashes.
    n_kept = f"size(filter(v, x -> c > {_BESIDE} and shiftright(x, 32) <= c - {_REACH}))"
    gaps = "transform(v, (x, i) -> cast(shiftright(x, 32) - coalesce(shiftright(get(v, i - 1), 32), 0L) as tinyint))"
    marks = _let(
        _chosen(_data("text")), "v",
        _let(f"octet_length({_KEPT})", "c", f"named_struct('hashes', concat(array({n_kept}), {_hashes('v')}), 'gaps', {gaps})"),
    )
    marked = rows.select("doc_id", "key", "text", F.inline(F.array(F.expr(marks))))
    asked = links.select(F.col("next").alias("key"), F.col("key").alias("asker"), "take")
    given = marked.join(asked, "key").select(
        F.col("asker").alias("key"), F.col("doc_id").alias("next_id"), F.expr("substring(text, 1, take)").alias("start"),
        "gaps", F.col("hashes").alias("next_hashes"),
    )
    # Hashes of the next document whose windows lie in the part given: how many come before them, and how many they are.
    count = """aggregate(gaps, named_struct('p', 0, 'a', 0, 'b', 0), (t, g) -> named_struct(
        'p', t.p + g, 'a', t.a + if(t.p + g < {low}, 1, 0), 'b', t.b + if(t.p + g <= {high}, 1, 0)))"""
    counted = count.format(low=WINDOW - 1, high=f"if(octet_length(start) > {_BESIDE}, octet_length(start) - {_REACH}, -1)")
    given = given.select("key", "next_id", "start", "next_hashes", F.expr(counted).alias("n")).select(
        "key", "next_id", "start", "next_hashes", F.col("n.a").alias("first_given"),
        F.expr("greatest(n.b - n.a, 0)").alias("n_given"),
    )
    both = marked.join(given.dropDuplicates(["key"]), "key")
    return both.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.expr(f"concat({_KEPT}, start)").alias("edited"),
        F.expr("slice(hashes, 2, size(hashes))").alias("hashes"),
        "gaps",
        F.expr(_edited_hashes()).alias("edited_hashes"),
        "next_id",
        F.expr("slice(next_hashes, 2, size(next_hashes))").alias("next_hashes"),
    )
