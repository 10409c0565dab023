"""Document fingerprints: Merkle trees over pieces, paragraphs and sections.

A text's sections are cut at empty lines, its paragraphs at line feeds, and a paragraph into
pieces of PIECE_CHARS characters from its start. A piece's node is the hash of its text, and so
is a paragraph's; a section's node hashes its paragraphs' nodes in order, the root its
sections'. The fingerprint writes the tree as text: the root, then for each section ``|`` and
its node, for each paragraph ``;`` and its node, then ``:`` and its pieces' nodes. Equal roots
mean equal texts; in different texts the differing branches name the sections, paragraphs and
pieces that were edited (``differing_branches``).

The likeness of two fingerprints is the share of pieces they have in common (twice the shared
over both, distinct pieces): 1 for equal texts, about 2/3 where the last third was replaced.

All work is built-in expressions. Null counts as the empty text, which has a root and no
pieces; two empty texts are alike 1, an empty and another text 0. Rows that share a doc_id
have the same next document; of several rows of the next doc_id, the one with the smallest
text hash counts. A null doc_id comes last. The only document is its own next. Texts are
taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pipecast.llm.store import keep, shuffle_partitions

PIECE_CHARS = 32

_TREE = f"""
transform(split({{text}}, '\\n\\n', -1), s -> transform(split(s, '\\n', -1), p -> struct(
  xxhash64(p) as node, transform(regexp_extract_all(p, '(?s).{{{{1,{PIECE_CHARS}}}}}', 0), x -> hash(x)) as pieces)))
"""


def tree(text: str) -> Column:
    """Array of sections, each an array of paragraphs (node, pieces), of the text column ``text``."""
    return F.expr(_TREE.format(text=text))


def _hex(h: str, digits: int) -> str:
    return f"lpad(lower(hex({h})), {digits}, '0')"


def _section_node(s: str) -> str:
    return f"xxhash64(transform({s}, p -> p.node))"


def fingerprint(tree_column: str) -> Column:
    """The tree with all its nodes, as text."""
    pieces = f"concat_ws('', transform(p.pieces, x -> right({_hex('cast(x as bigint)', 16)}, 8)))"
    paragraphs = f"concat_ws('', transform(s, p -> concat(';', {_hex('p.node', 16)}, ':', {pieces})))"
    sections = f"concat_ws('', transform({tree_column}, s -> concat('|', {_hex(_section_node('s'), 16)}, {paragraphs})))"
    root = f"sha2(concat_ws(',', transform({tree_column}, s -> {_hex(_section_node('s'), 16)})), 256)"
    return F.expr(f"concat({root}, {sections})")


def pieces(tree_column: str) -> Column:
    """The distinct pieces' nodes of a tree."""
    return F.expr(f"array_distinct(flatten(transform(flatten({tree_column}), p -> p.pieces)))")


def likeness(one: str, other: str) -> Column:
    """Share of common pieces of two arrays of distinct pieces, 0 to 1."""
    total = f"(size({one}) + size({other}))"
    return F.expr(f"if({total} = 0, 1.0D, 2.0D * size(array_intersect({one}, {other})) / {total})")


def differing_branches(one: str, other: str) -> Column:
    """(section, paragraph, piece) numbers, from 0, of the pieces of tree ``one`` that ``other`` lacks at that place.

    Sections and paragraphs whose nodes agree are passed over whole.
    """
    return F.expr(f"""
    flatten(flatten(transform({one}, (s, i) ->
      transform(filter(transform(s, (p, j) -> struct(j as j, p as p)),
                       e -> not (e.p.node <=> get(get({other}, i), e.j).node)), e ->
        filter(transform(e.p.pieces, (x, k) -> if(x <=> get(get(get({other}, i), e.j).pieces, k), null,
          named_struct('section', i, 'paragraph', e.j, 'piece', k))), d -> d is not null)))))
    """)


def previous_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, previous, longest): for each id the next larger one, of the largest the smallest, and its texts' largest length.

    Ids are sorted into ranges; inside a range a window finds the neighbour, and one row a
    range links the ranges to a circle.
    """
    lengths = docs.groupBy("doc_id").agg(F.max(F.char_length("text")).alias("longest"))
    order = F.col("doc_id").desc_nulls_last()
    ranged = lengths.repartitionByRange(shuffle_partitions(docs.sparkSession), order)
    ids = keep(
        ranged.select(F.struct("doc_id", "longest").alias("id"), F.spark_partition_id().alias("part")), "fingerprint-ids"
    )
    inside = Window.partitionBy("part").orderBy(F.col("id.doc_id").desc_nulls_last())
    ranked = ids.withColumn("previous", F.lag("id").over(inside)).withColumn("last", F.lead("id").over(inside).isNull())
    circle, everything = Window.orderBy("part"), Window.partitionBy()
    borders = ranked.where("last").select("part", F.col("id").alias("end"))
    borders = borders.select(
        "part", F.coalesce(F.lag("end").over(circle), F.max_by("end", "part").over(everything)).alias("before")
    )
    linked = ranked.join(F.broadcast(borders), "part")
    return linked.select(
        "id.doc_id",
        F.coalesce("previous", "before").alias("previous"),
    ).select("doc_id", F.col("previous.doc_id").alias("previous"), F.col("previous.longest").alias("longest"))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one row for each of ``docs``.

    The edited text has its last third replaced by the beginning of the next document, by
    descending doc_id; after the last comes the first.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    links = previous_ids(texts).withColumnRenamed("doc_id", "id")
    followers = texts.join(links, F.col("doc_id").eqNullSafe(F.col("id"))).select(
        F.col("previous"),
        F.expr("substring(text, 1, cast(longest div 3 as int))").alias("beginning"),
        F.xxhash64("text").alias("tie"),
        tree("text").alias("t"),
    )
    followers = followers.select("previous", "beginning", "tie", pieces("t").alias("next_pieces"))
    first = F.row_number().over(Window.partitionBy("previous").orderBy("tie"))
    followers = followers.withColumn("nth", first).where("nth = 1").drop("nth", "tie")
    rows = texts.join(followers, F.col("doc_id").eqNullSafe(F.col("previous")))
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long")).withColumn(
        "edited",
        F.expr(
            "concat(substring(text, 1, cast(n_chars - n_chars div 3 as int)),"
            " substring(beginning, 1, cast(n_chars div 3 as int)))"
        ),
    )
    rows = rows.select("doc_id", "n_chars", "edited", "next_pieces", tree("text").alias("t"), tree("edited").alias("e"))
    rows = rows.select("*", pieces("t").alias("own"), pieces("e").alias("changed"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("t").alias("fingerprint"),
        fingerprint("e").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "next_pieces").alias("near_next"),
    )
