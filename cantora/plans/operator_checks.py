"""One query per operator over the test tables, each with its check query where SQL can say it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cantora.functions import claims, coerce, metrics, sentiment
from cantora.functions import text as T
from cantora.operators import loading, matching, numbering, resolve, shape
from cantora.operators.enrich import spread
from cantora.operators.loading import ChildOf, Rule
from cantora.plans import oracle_parts as O
from cantora.plans.model import STANDIN_RULES, Model, union_all
from cantora.plans.refresh import LyricsMarts
from cantora.session import shared_folder
from cantora.sources import landed

QUERIES: dict[str, Callable[[Model], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query, with its check query unless SQL cannot express it."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


def queries():
    return {name: (lambda spark, sf_dir, fn=fn: fn(Model(spark, sf_dir))) for name, fn in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(CHECKS)


def long(c) -> object:
    return c.cast("bigint")


def _docs(m: Model) -> DataFrame:
    """Whole document texts, spread over the cores for heavy row-local work."""
    return spread(m.raw("documents").select("doc_id", "text", "lang", "source"), "doc_id")


# ---- sources ----------------------------------------------------------------------------


@check("a6_inventory", "SELECT DISTINCT lang AS artist, source AS album FROM documents WHERE source IS NOT NULL")
def a6(m):
    return resolve.inventory(m.raw("documents").select(F.col("lang").alias("artist"), F.col("source").alias("album")))


@check(
    "a9_summary",
    f"""WITH {O.TRACKS} SELECT t.id AS track_no, t.name AS title, CASE WHEN length(d.text) > 0 THEN '✅' ELSE '❌' END AS has_lyrics,
    CASE WHEN length(d.text) > 0 THEN 'tracks/' || t.id ELSE 'N/A' END AS url FROM tracks t LEFT JOIN documents d ON t.id = d.doc_id""",
)
def a9(m):
    tracks = m.tracks().select(F.col("id").alias("track_no"), F.col("name").alias("title"))
    found = m.lyrics().select(
        F.col("track_id").alias("track_no"), T.has_lyrics(F.col("text")).alias("has_text"),
        F.concat(F.lit("tracks/"), F.col("track_id").cast("string")).alias("url"),
    )
    return landed.album_summary(tracks.join(found, "track_no", "left"), "has_text")


@check(
    "a14_json",
    "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.uri'), '') AS uri FROM events",
)
def a14(m):
    parsed = m.raw("events").withColumn("p", F.from_json("props", "k bigint, uri string"))
    return parsed.select("event_id", "event_type", F.col("p.k").alias("k"), F.coalesce("p.uri", F.lit("")).alias("uri"))


@check(
    "a15_claims",
    """SELECT event_id, key AS property, CASE WHEN type IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN 'number' WHEN type = 'VARCHAR' THEN 'string'
      ELSE lower(type) END AS kind, json_extract_string(props, '$.' || key) AS text, TRY_CAST(json_extract_string(props, '$.' || key) AS BIGINT) AS amount
    FROM (SELECT event_id, props, key, json_type(props, '$.' || key) AS type FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events))""",
)
def a15(m):
    """All members of the event payloads, whatever their names and types."""
    parsed = m.raw("events").select("event_id", F.try_parse_json("props").alias("v"))
    item = F.col("item")
    return landed.variant_items(parsed, "v").select(
        "event_id", F.col("item_key").alias("property"), claims.variant_kind(item).alias("kind"),
        claims.variant_text(item).alias("text"), F.try_variant_get(item, "$", "bigint").alias("amount"))


@check(
    "a16_html_items",
    """SELECT page_id, CAST(generate_subscripts(items, 1) AS BIGINT) AS n, unnest(items) AS title FROM
    (SELECT page_id, regexp_extract_all(html, '<li><a[^>]*>([^<]*)</a>', 1) AS items FROM pages)""",
)
def a16(m):
    return landed.numbered_matches(m.raw("pages"), "html", r"<li><a[^>]*>([^<]*)</a>").select(
        "page_id", "n", F.col("raw_title").alias("title")
    )


@check(
    "a20_skipped",
    """SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'new') OR contains(lower(p_name), 'ring')""",
)
def a20(m):
    return m.raw("part").where(T.excluded_album(F.col("p_name"), ("new", "ring"))).select("p_partkey", "p_name")


# ---- projections and filters ------------------------------------------------------------


@check(
    "b1_b3_shape",
    """SELECT o_orderkey AS "SongName", o_totalprice AS "DurationMs", o_custkey AS "AlbumName" FROM orders""",
)
def b1_b3(m):
    slim = shape.drop_present(m.raw("orders"), ["o_orderpriority", "Label", "URI"])
    named = shape.rename_present(
        slim, {"o_orderkey": "SongName", "o_custkey": "AlbumName", "o_totalprice": "DurationMs", "Popularity": "SongPopularity"}
    )
    return shape.select_present(named, ("SongName", "SongPopularity", "DurationMs", "AlbumName"))


@check(
    "b4_pending",
    "SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL OR l.toxic IS NULL",
)
def b4(m):
    joined = m.raw("documents").select("doc_id", "lang").join(m.raw("labels"), "doc_id", "left")
    return shape.pending(joined, ("quality", "toxic")).select("doc_id", "lang")


@check(
    "b5_valid_names",
    "SELECT p_partkey, p_name FROM part WHERE NOT (contains(lower(p_name), 'new') OR contains(lower(p_name), 'ring'))",
)
def b5(m):
    return m.raw("part").where(~T.excluded_album(F.col("p_name"), ("new", "ring"))).select("p_partkey", "p_name")


@check(
    "b11_unresolved",
    """SELECT d.doc_id, d.source, l.doc_id IS NOT NULL AS resolved FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def b11(m):
    good, orphans = loading.lookup(m.raw("documents").select("doc_id", "source"), m.raw("labels").select("doc_id"), ["doc_id"])
    return good.withColumn("resolved", F.lit(True)).unionByName(orphans.withColumn("resolved", F.lit(False)))


@check(
    "b12_defaults",
    """SELECT d.doc_id, CAST(coalesce(l.quality, 0) AS BIGINT) AS quality, coalesce(nullif(trim(d.source), ''), '') AS source,
    coalesce(d.text, '') AS text FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def b12(m):
    joined = m.raw("documents").select("doc_id", "source", "text").join(m.raw("labels"), "doc_id", "left")
    return joined.withColumn("source", T.blank_to_null(F.col("source"))).na.fill(0, ["quality"]).na.fill("", ["source", "text"]).select(
        "doc_id", long(F.col("quality")).alias("quality"), "source", "text"
    )


# ---- joins ------------------------------------------------------------------------------


@check(
    "c1_left_join",
    """SELECT CAST(o_orderkey AS VARCHAR) AS "Name", c.c_name AS "Album", o_totalprice AS "Popularity", a.name AS "Name_album",
    a.pop AS "Popularity_album" FROM orders JOIN customer c ON o_custkey = c.c_custkey
    LEFT JOIN (SELECT c_name AS name, c_acctbal AS pop FROM customer WHERE c_acctbal > 0) a ON c.c_name = a.name""",
)
def c1(m):
    customer = m.raw("customer")
    tracks = m.raw("orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("string").alias("Name"), F.col("c_name").alias("Album"), F.col("o_totalprice").alias("Popularity")
    )
    albums = customer.where("c_acctbal > 0").select(F.col("c_name").alias("Name"), F.col("c_acctbal").alias("Popularity"))
    return shape.join_album_metadata(tracks, albums)


@check(
    "c2_artist_merge",
    """WITH cat AS (SELECT c_name AS name, c_mktsegment AS genres, CAST(c_acctbal AS VARCHAR) AS followers FROM customer),
    prof AS (SELECT ' ' || replace(s_name, 'Supplier', 'CUSTOMER') AS artist, CAST(s_nationkey AS VARCHAR) AS genres FROM supplier
             UNION ALL SELECT r_name, NULL FROM region)
    SELECT coalesce(name, artist) AS "Name", p.genres AS "GenresWikidata", c.genres AS "GenresSpotify",
    coalesce(TRY_CAST(trunc(TRY_CAST(followers AS DOUBLE)) AS BIGINT), 0) AS "Followers"
    FROM cat c FULL JOIN prof p ON lower(trim(name)) = lower(trim(artist))""",
)
def c2(m):
    catalog = m.raw("customer").select(
        F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Genres"),
        F.col("c_acctbal").cast("string").alias("Followers"), F.lit("x").alias("URI"),
    )
    suppliers = m.raw("supplier").select(
        F.concat(F.lit(" "), F.replace("s_name", F.lit("Supplier"), F.lit("CUSTOMER"))).alias("Artist"),
        F.col("s_nationkey").cast("string").alias("Genres"),
    )
    regions = m.raw("region").select(F.col("r_name").alias("Artist"), F.lit(None).cast("string").alias("Genres"))
    return shape.merge_artists(catalog, suppliers.unionByName(regions))


@check(
    "c3_contains",
    "SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)",
)
def c3(m):
    passages = m.raw("benchmark").select("item_id", F.col("text").alias("passage"))
    return matching.passage_hits(_docs(m), passages, "doc_id", "item_id")


_TITLES = """keyed AS (SELECT p_partkey AS part, p_brand AS brand, p_name AS title,
    regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS title_key FROM part WHERE p_size <= 25),
    files AS (SELECT p_brand AS brand, lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS path, p_name || ' ' || p_type AS text,
    regexp_replace(lower(p_name), '[ _-]', '', 'g') AS stem_key FROM part WHERE p_size > 25),
    wanted AS (SELECT DISTINCT brand, title_key FROM keyed WHERE title_key <> ''),
    stems AS (SELECT brand, stem_key, min(path) AS path FROM files WHERE stem_key <> '' GROUP BY brand, stem_key)"""

# Ratcliff/Obershelp by its definition: the longest common block (ties: first in a, then first in b),
# then the same to its left and right; the similarity is twice the letters in blocks over all letters.
_BLOCK = """list_filter(flatten(list_transform(range(length(x), 0, -1), lambda k: list_transform(range(1, length(x) - k + 2),
    lambda i: {'k': k, 'i': i}))), lambda s: contains(y, substr(x, s.i, s.k)))[1]"""
_RATIOS = f"""pairs AS (SELECT DISTINCT stem_key AS a, title_key AS b FROM wanted w JOIN stems s ON w.brand = s.brand
      AND 2.0 * least(length(title_key), length(stem_key)) / (length(title_key) + length(stem_key)) >= 0.7),
    rests AS (SELECT a, b, a AS x, b AS y, 0 AS k FROM pairs
      UNION ALL
      SELECT a, b, CASE side WHEN 1 THEN substr(x, 1, CAST(block.i - 1 AS BIGINT)) WHEN 2 THEN substr(x, CAST(block.i + block.k AS BIGINT)) ELSE '' END,
        CASE side WHEN 1 THEN substr(y, 1, CAST(spot - 1 AS BIGINT)) WHEN 2 THEN substr(y, CAST(spot + block.k AS BIGINT)) ELSE '' END,
        CASE side WHEN 0 THEN CAST(block.k AS INTEGER) ELSE 0 END
      FROM (SELECT *, strpos(y, substr(x, block.i, block.k)) AS spot FROM (SELECT a, b, x, y, {_BLOCK} AS block FROM rests WHERE x <> '' AND y <> '') q1
            WHERE block IS NOT NULL) q2 CROSS JOIN (VALUES (0), (1), (2)) sides(side)),
    ratios AS (SELECT a, b, 2.0 * CAST(sum(k) AS DOUBLE) / (length(a) + length(b)) AS score FROM rests GROUP BY a, b)"""
_MATCHES = f"""{_RATIOS},
    contained AS (SELECT w.brand, w.title_key, min(path) AS path FROM wanted w
      JOIN stems s ON w.brand = s.brand AND contains(stem_key, title_key) GROUP BY w.brand, w.title_key),
    ranked AS (SELECT w.brand, w.title_key, s.path, score,
      row_number() OVER (PARTITION BY w.brand, w.title_key ORDER BY score DESC, stem_key DESC) AS place
      FROM wanted w JOIN stems s ON w.brand = s.brand JOIN ratios ON a = stem_key AND b = title_key WHERE score >= 0.7),
    likest AS (SELECT * FROM ranked WHERE place = 1),
    matched AS (SELECT t.part, t.brand, t.title, t.title_key, coalesce(c.path, f.path) AS match_path,
      CASE WHEN c.path IS NOT NULL THEN 'contains' WHEN f.path IS NOT NULL THEN 'fuzzy' ELSE 'missing' END AS tier,
      CASE WHEN c.path IS NOT NULL THEN CAST(1.0 AS DOUBLE) ELSE f.score END AS score FROM keyed t
      LEFT JOIN contained c ON t.brand = c.brand AND t.title_key = c.title_key
      LEFT JOIN likest f ON t.brand = f.brand AND t.title_key = f.title_key)"""


@check(
    "a19_match_audit",
    f"""WITH RECURSIVE {_TITLES}, {_MATCHES} SELECT part, brand, CASE WHEN match_path IS NULL THEN 'missing' ELSE 'matched' END AS outcome,
    CASE WHEN match_path IS NULL THEN title ELSE title || ' --> ' || match_path END AS line, tier, score FROM matched""",
)
def a19(m):
    return landed.match_audit(matching.match_lyrics(m.titles(), m.files(), scope=("brand",)), ["part", "brand"], "title")


@check(
    "c3_title_match",
    f"""WITH {_TITLES} SELECT w.brand, w.title_key, min(path) AS path FROM wanted w
    JOIN stems s ON w.brand = s.brand AND contains(stem_key, title_key) GROUP BY w.brand, w.title_key""",
)
def c3_title(m):
    return matching.containment_hits(m.titles(), m.files(), scope=("brand",))


@check(
    "c4_quick_ratio",
    f"""WITH {_TITLES}, pairs AS (SELECT w.brand, title_key, stem_key FROM wanted w JOIN stems s ON w.brand = s.brand
      AND 2.0 * least(length(title_key), length(stem_key)) / (length(title_key) + length(stem_key)) >= 0.7),
    scored AS (SELECT brand, title_key, stem_key, CAST(2 * list_sum(list_transform(list_distinct(string_split(title_key, '')),
      lambda c: least(length(title_key) - length(replace(title_key, c, '')), length(stem_key) - length(replace(stem_key, c, ''))))) AS DOUBLE)
      / (length(title_key) + length(stem_key)) AS bound FROM pairs)
    SELECT brand, title_key, count(*) AS candidates, round(max(bound), 6) AS best_bound FROM scored WHERE bound >= 0.7 GROUP BY brand, title_key""",
)
def c4_quick(m):
    titles = m.titles().where("title_key <> ''").select("brand", "title_key").distinct()
    stems = m.files().where("stem_key <> ''").groupBy("brand", "stem_key").agg(F.min("path").alias("path"))
    return matching.fuzzy_candidates(titles, stems, ("brand",)).groupBy("brand", "title_key").agg(
        F.count(F.lit(1)).alias("candidates"), F.round(F.max("bound"), 6).alias("best_bound")
    )


@check("c4_fuzzy", f"WITH RECURSIVE {_TITLES}, {_MATCHES} SELECT brand, title_key, path, score FROM likest")
def c4(m):
    return matching.fuzzy_hits(m.titles(), m.files(), scope=("brand",))


@check(
    "c5_match",
    f"""WITH RECURSIVE {_TITLES}, {_MATCHES} SELECT m.*, coalesce(files.text, '') AS "Lyrics" FROM matched m
    LEFT JOIN files ON m.match_path = files.path""",
)
def c5(m):
    return matching.attach_text(matching.match_lyrics(m.titles(), m.files(), scope=("brand",)), m.files())


@check(
    "c6_lookup",
    f"""WITH {O.MODEL} SELECT t.id AS track_id, al.id AS album_id, ar.id AS artist_id FROM tracks t JOIN albums al ON t.album_id = al.id
    JOIN artists ar ON al.artist_id = ar.id""",
)
def c6(m):
    named = m.tracks().select(F.col("id").alias("track_id"), "album_id").join(
        m.albums().select(F.col("id").alias("album_id"), F.col("name").alias("album"), "artist_id"), "album_id"
    ).select("track_id", "album", "artist_id")
    albums = m.albums().select(F.col("id").alias("album_id"), F.col("name").alias("album"), "artist_id")
    return loading.lookup(named, albums, ["album", "artist_id"])[0].select("track_id", "album_id", "artist_id")


@check("c7_star", f"WITH {O.MODEL}, {O.STAR} SELECT track_id, track, album, artist FROM star")
def c7(m):
    return m.star().select("track_id", "track", "album", "artist")


@check(
    "c9_labels",
    """WITH ids AS (SELECT p_partkey, string_split(p_name, ' ') AS q FROM part),
    flat AS (SELECT p_partkey, unnest(q) AS qid, generate_subscripts(q, 1) AS pos FROM ids),
    labels_en AS (SELECT DISTINCT lower(p_type) AS qid, p_type AS label FROM part)
    SELECT p_partkey, string_agg(coalesce(label, flat.qid), ', ' ORDER BY pos) AS labels FROM flat LEFT JOIN labels_en ON flat.qid = labels_en.qid
    GROUP BY p_partkey""",
)
def c9(m):
    part = m.raw("part")
    labels = part.select(F.lower("p_type").alias("qid"), F.col("p_type").alias("label_en")).distinct()
    ids = part.select("p_partkey", F.split("p_name", " ").alias("ids"))
    named = resolve.attach_labels(ids, "p_partkey", "ids", labels, "labels")
    return named.select("p_partkey", T.join_names(F.col("labels")).alias("labels"))


@check("c10_not_done", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def c10(m):
    return loading.not_done(m.raw("documents").select("doc_id", "source"), m.raw("labels"), ["doc_id"])


@check(
    "c11_complete",
    "SELECT source FROM documents WHERE lang IN ('en', 'fr', 'de', 'es') GROUP BY source HAVING count(DISTINCT lang) = 4",
)
def c11(m):
    return loading.inputs_complete(m.raw("documents"), ["source"], "lang", ["en", "fr", "de", "es"])


@check(
    "c12_resolve",
    """WITH hits AS (SELECT l_orderkey AS request_id, l_linenumber AS pos, l_partkey AS id, ' ' || p_name AS name, p_brand AS brand
      FROM lineitem JOIN part ON l_partkey = p_partkey),
    asked AS (SELECT request_id, upper(min(brand || '/' || trim(name))) AS w FROM hits GROUP BY request_id)
    SELECT a.request_id, (SELECT arg_min(id, (pos, id)) FROM hits h WHERE h.request_id = a.request_id
      AND lower(trim(h.name)) = lower(string_split(a.w, '/')[2]) AND lower(h.brand) = lower(string_split(a.w, '/')[1])) AS album_id FROM asked a""",
)
def c12(m):
    found = m.raw("lineitem").join(m.raw("part"), F.col("l_partkey") == F.col("p_partkey"))
    hits = found.select(
        F.col("l_orderkey").alias("request_id"), F.struct("l_linenumber", "l_partkey").alias("pos"), F.col("l_partkey").alias("id"),
        F.concat(F.lit(" "), "p_name").alias("name"), F.array(F.struct(F.col("p_brand").alias("name"))).alias("artists"),
    )
    wish = F.split(F.upper(F.min(F.concat_ws("/", "p_brand", "p_name"))), "/").alias("w")
    requests = found.groupBy(F.col("l_orderkey").alias("request_id")).agg(wish).select(
        "request_id", F.col("w")[0].alias("artist"), F.col("w")[1].alias("album")
    )
    return resolve.resolve_albums(requests, hits).select("request_id", "album_id")


# ---- aggregates, keys, integrity --------------------------------------------------------

_WORDS = f"WITH {O.MODEL}, {O.track_words()}, {O.ALBUM_WORDS}"


@check("d1_word_freq_track", f"WITH {O.track_words()} SELECT track_id, word, count FROM track_words")
def d1(m):
    return m.track_words()


@check("d2_word_freq_album", f"{_WORDS} SELECT album_id, word, count FROM album_words")
def d2(m):
    return m.album_words()


@check(
    "d7_dedupe",
    """SELECT p_brand, p_partkey, p_name FROM part QUALIFY row_number() OVER (PARTITION BY p_brand, lower(p_name) ORDER BY p_partkey) = 1""",
)
def d7(m):
    return resolve.unique_names(
        m.raw("part").select("p_brand", "p_partkey", "p_name"), ["p_brand"], "p_name", [F.col("p_partkey")]
    )


@check(
    "d8_insert_ignore",
    """SELECT p_brand, p_name, p_partkey, p_type FROM part p WHERE NOT EXISTS (SELECT 1 FROM part t WHERE t.p_type = 'ECONOMY'
    AND t.p_brand = p.p_brand AND t.p_name = p.p_name) QUALIFY row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) = 1""",
)
def d8(m):
    part = m.raw("part").select("p_brand", "p_name", "p_partkey", "p_type")
    loaded = part.where("p_type = 'ECONOMY'")
    return loading.insert_ignore(loaded, part, ["p_brand", "p_name"], [F.col("p_partkey")], nullable=())


@check("d9_ids", "SELECT c_custkey, c_name, row_number() OVER (ORDER BY md5(c_name), c_name) AS id FROM customer")
def d9(m):
    return numbering.dense_ids(m.raw("customer").select("c_custkey", "c_name"), ["c_name"], "id")


@check(
    "d10_upsert",
    """SELECT c_custkey, coalesce(arg_max(o_orderkey, (o_orderdate, o_orderkey)), -1) AS last_order,
    coalesce(arg_max(o_totalprice, (o_orderdate, o_orderkey)), 0.0) AS last_total
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
)
def d10(m):
    target = m.raw("customer").select(
        "c_custkey", F.lit(-1).cast("bigint").alias("last_order"), F.lit(0.0).alias("last_total")
    )
    incoming = m.raw("orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("last_order"),
        F.col("o_totalprice").alias("last_total"), "o_orderdate",
    )
    return loading.upsert(target, incoming, ["c_custkey"], [F.col("o_orderdate"), F.col("last_order")], nullable=())


@check(
    "d11_first_attr",
    """SELECT l_orderkey, l_partkey, l_returnflag, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice) = 1""",
)
def d11(m):
    rows = m.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_extendedprice")
    return loading.first_per_key(rows, [F.col("l_orderkey")], [F.col(c) for c in ("l_linenumber", "l_partkey", "l_extendedprice")]).drop("l_linenumber")


_DQ = (
    Rule("unique", "part", ("p_brand", "p_name")),
    Rule("unique", "part", ("p_partkey",)),
    Rule("not_null", "documents", ("text", "lang")),
    Rule("foreign", "documents", ("doc_id",), "labels", "doc_id"),
    Rule("foreign", "lineitem", ("l_orderkey",), "orders", "o_orderkey"),
)


@check(
    "d12_dq",
    """SELECT 'part' AS table_name, 'unique' AS rule, 'p_brand,p_name' AS columns, CAST(count(*) - count(DISTINCT (p_brand, p_name)) AS BIGINT) AS violations FROM part
    UNION ALL SELECT 'part', 'unique', 'p_partkey', CAST(count(*) - count(DISTINCT p_partkey) AS BIGINT) FROM part
    UNION ALL SELECT 'documents', 'not_null', 'text,lang', count(*) FROM documents WHERE text IS NULL OR lang IS NULL
    UNION ALL SELECT 'documents', 'foreign', 'doc_id', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT 'lineitem', 'foreign', 'l_orderkey', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
)
def d12(m):
    return loading.violations({t: m.raw(t) for t in ("part", "documents", "labels", "lineitem", "orders")}, _DQ)


@check(
    "d13_cascade",
    f"""WITH {O.MODEL}, dead AS (SELECT id FROM artists WHERE name = 'NATION_3')
    SELECT 'artists' AS table_name, id FROM artists WHERE id NOT IN (SELECT id FROM dead)
    UNION ALL SELECT 'albums', id FROM albums WHERE artist_id NOT IN (SELECT id FROM dead)
    UNION ALL SELECT 'tracks', t.id FROM tracks t JOIN albums a ON t.album_id = a.id WHERE artist_id NOT IN (SELECT id FROM dead)
    UNION ALL SELECT 'lyrics', d.doc_id FROM documents d JOIN tracks t ON d.doc_id = t.id JOIN albums a ON t.album_id = a.id
      WHERE artist_id NOT IN (SELECT id FROM dead)""",
)
def d13(m):
    tables = {"artists": m.artists(), "albums": m.albums(), "tracks": m.tracks(), "lyrics": m.lyrics()}
    links = (
        ChildOf("albums", "artist_id", "artists"), ChildOf("tracks", "album_id", "albums"), ChildOf("lyrics", "track_id", "tracks"),
    )
    left = loading.cascade_delete(tables, "artists", F.col("name") == "NATION_3", links)
    return union_all([
        df.select(F.lit(t).alias("table_name"), F.col("track_id" if t == "lyrics" else "id").alias("id")) for t, df in left.items()
    ])


@check(
    "d15_update",
    f"""SELECT d.doc_id, CASE WHEN quality IS NULL THEN {O.fill(O.WORDS, 'text')} ELSE CAST(quality AS BIGINT) END AS score
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def d15(m):
    current = m.raw("documents").select("doc_id", "text").join(
        m.raw("labels").select("doc_id", long(F.col("quality")).alias("score")), "doc_id", "left"
    )
    todo = shape.pending(current, ("score",))
    computed = todo.select("doc_id", metrics.words(F.col("text")).alias("score"))
    return loading.update_rows(current.select("doc_id", "score"), computed, "doc_id")


@check(
    "d14_marts_refresh",
    f"""WITH {O.TRACKS}, changed AS (SELECT d.doc_id, CASE WHEN quality = 0 THEN text || ' encore' ELSE text END AS text
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE toxic IS DISTINCT FROM 1),
    {O.track_words('changed')}, {O.ALBUM_WORDS} SELECT album_id, word, count FROM album_words""",
)
def d14(m):
    """Album words after changes: poor texts get a word, toxic ones go, and only their partitions are rewritten."""
    albums = m.tracks().select(F.col("id").alias("track_id"), "album_id")
    texts = spread(m.lyrics(), "track_id").join(albums, "track_id")
    labels = m.raw("labels").select(F.col("doc_id").alias("track_id"), "quality", "toxic").where("quality = 0 or toxic = 1")
    marts = LyricsMarts(f"{shared_folder(m.spark, tempfile.gettempdir())}/marts-{uuid.uuid4().hex}", parts=64, rules=STANDIN_RULES)
    marts.build(texts)
    marts.apply(texts.join(labels, "track_id").select(
        "track_id", "album_id", F.concat("text", F.lit(" encore")).alias("text"), (F.col("toxic") == 1).alias("deleted"),
        F.lit(1).alias("modified"),
    ))
    return marts.read(m.spark, "words_album").select("album_id", "word", "count")


# ---- order ------------------------------------------------------------------------------


@check(
    "e2_track_number",
    """SELECT o_custkey AS album_id, o_orderkey AS id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS track_number FROM orders""",
)
def e2(m):
    return numbering.number_by(m.tracks().select("album_id", "id"), ["album_id"], "id", "track_number")


@check(
    "f3_top1",
    "SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1",
)
def f3(m):
    hits = m.raw("events").select("user_id", "event_id", "value")
    return resolve.top_hit(hits, ["user_id"], [-F.col("value"), F.col("event_id")])


@check(
    "g1_union_pages",
    """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""",
)
def g1(m):
    first = m.raw("customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    second = m.raw("supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return resolve.union_pages([first, second])


# ---- scalar functions -------------------------------------------------------------------

_FORBIDDEN = r"""[<>:"/\\|?*]"""


@check("h1_sanitize_delete", f"SELECT page_id, trim(regexp_replace(url, {O.quote(_FORBIDDEN)}, '', 'g')) AS name FROM pages")
def h1(m):
    return m.raw("pages").select("page_id", T.sanitize_delete(F.col("url")).alias("name"))


@check("h2_sanitize_hyphen", f"SELECT page_id, trim(regexp_replace(url, {O.quote(_FORBIDDEN)}, '-', 'g')) AS name FROM pages")
def h2(m):
    return m.raw("pages").select("page_id", T.sanitize_hyphen(F.col("url")).alias("name"))


def _slug_sql(x: str) -> str:
    ascii_only = f"regexp_replace(strip_accents(lower({x})), '[^\\x00-\\x7F]', '', 'g')"
    quotes_out = f"regexp_replace({ascii_only}, '[''\"()]+', '', 'g')"
    return f"trim(regexp_replace({quotes_out}, '[^a-z0-9]+', '-', 'g'), '-')"


@check(
    "h3_slugify",
    f"SELECT doc_id, {_slug_sql('text')} AS slug, 'albums/' || {_slug_sql('lang')} || '/' || {_slug_sql('source')} AS page FROM documents",
)
def h3(m):
    return _docs(m).select(
        "doc_id", T.slugify(F.col("text")).alias("slug"), T.album_page_path(F.col("lang"), F.col("source")).alias("page")
    )


@check(
    "h4_clean_title",
    """WITH t AS (SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name || ' / ' || p_type || ' (Ft. ' || p_brand || ') Lyrics' ELSE 'Lyrics ' || p_name END AS x FROM part)
    SELECT p_partkey, replace(trim(replace(CASE WHEN contains(x, '(Ft') THEN regexp_extract(x, '(.*)\\(Ft', 1) ELSE x END, 'Lyrics', '')), '/', '-') AS title FROM t""",
)
def h4(m):
    raw = F.when(
        F.col("p_size") > 25, F.concat("p_name", F.lit(" / "), "p_type", F.lit(" (Ft. "), "p_brand", F.lit(") Lyrics"))
    ).otherwise(F.concat(F.lit("Lyrics "), "p_name"))
    return m.raw("part").select("p_partkey", T.clean_title(raw).alias("title"))


@check("h5_title_key", "SELECT doc_id, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS title_key FROM documents")
def h5(m):
    return m.raw("documents").select("doc_id", T.title_key(F.col("text")).alias("title_key"))


@check("h6_stem_key", "SELECT doc_id, regexp_replace(lower(text), '[ _-]', '', 'g') AS stem_key FROM documents")
def h6(m):
    return m.raw("documents").select("doc_id", T.stem_key(F.col("text")).alias("stem_key"))


@check("h7_join_list", "SELECT doc_id, array_to_string(string_split(text, ' '), ', ') AS names FROM documents")
def h7(m):
    return m.raw("documents").select("doc_id", T.join_names(F.split("text", " ")).alias("names"))


@check(
    "h8_combine",
    """SELECT d.doc_id, concat_ws(', ', nullif(trim(CASE WHEN l.quality = 1 THEN ' ' || source END), ''), nullif(trim(CASE WHEN l.toxic = 0 THEN lang || ' ' ELSE ' ' END), '')) AS genres
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def h8(m):
    joined = m.raw("documents").select("doc_id", "source", "lang").join(m.raw("labels"), "doc_id", "left")
    first = F.when(F.col("quality") == 1, F.concat(F.lit(" "), "source"))
    second = F.when(F.col("toxic") == 0, F.concat("lang", F.lit(" "))).otherwise(F.lit(" "))
    return joined.select("doc_id", T.combine_genres(first, second).alias("genres"))


@check(
    "h9_dates",
    """WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderstatus AS s FROM orders),
    r AS (SELECT o_orderkey, CASE s WHEN 'F' THEN substr(d, 1, 4) WHEN 'O' THEN substr(d, 1, 7) WHEN 'P' THEN d END AS raw FROM t)
    SELECT o_orderkey, CAST(coalesce(try_strptime(raw, '%Y-%m-%d'), try_strptime(raw, '%Y-%m'), try_strptime(raw, '%Y')) AS DATE) AS release_date,
    strftime(try_strptime(raw, '%Y-%m-%d'), '%Y-%m-%d') AS full_text FROM r""",
)
def h9(m):
    full = F.date_format("o_orderdate", "yyyy-MM-dd")
    status = F.col("o_orderstatus")
    raw = F.when(status == "F", F.substring(full, 1, 4)).when(status == "O", F.substring(full, 1, 7)).when(status == "P", full)
    return m.raw("orders").select(
        "o_orderkey", coerce.to_date_lenient(raw).alias("release_date"),
        F.when(F.length(raw) == 10, coerce.iso_date_text(raw)).alias("full_text"),
    )


@check(
    "h10_claim_date",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS birth_date, strftime(ts, '%Y') AS work_start,
    CASE WHEN event_type = 'view' THEN '' ELSE strftime(ts, '%Y') END AS sometimes FROM events""",
)
def h10(m):
    time = F.concat(F.lit('{"time": "+'), F.date_format("ts", "yyyy-MM-dd"), F.lit('T00:00:00Z", "precision": 11}'))
    sometimes = F.when(F.col("event_type") != "view", time)
    return m.raw("events").select(
        "event_id", claims.claim_date(time).alias("birth_date"), claims.claim_date(time, 4).alias("work_start"),
        claims.claim_date(sometimes, 4).alias("sometimes"),
    )


@check(
    "h11_to_int",
    """SELECT o_orderkey, CAST(coalesce(trunc(TRY_CAST(o_totalprice AS DOUBLE)), 0) AS BIGINT) AS duration, CAST(0 AS BIGINT) AS priority,
    coalesce(TRY_CAST(split_part(o_orderpriority, '-', 1) AS BIGINT), 0) AS rank FROM orders""",
)
def h11(m):
    return m.raw("orders").select(
        "o_orderkey", coerce.to_int_or_zero(F.col("o_totalprice").cast("string")).alias("duration"),
        coerce.to_int_or_zero(F.col("o_orderpriority")).alias("priority"),
        coerce.to_int_or_zero(F.split("o_orderpriority", "-")[0]).alias("rank"),
    )


@check(
    "h12_to_bool",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS explicit FROM orders""",
)
def h12(m):
    status = F.col("o_orderstatus")
    raw = F.when(status == "F", F.lit("True")).when(status == "O", F.lit("False")).otherwise(F.lit("n/a"))
    return m.raw("orders").select("o_orderkey", coerce.to_bool(raw).alias("explicit"))


@check(
    "h13_url",
    f"""SELECT p_partkey, CASE WHEN p_size > 25 THEN '{claims.IMAGE_PREFIX}' || replace(p_name, ' ', '_') ELSE '' END AS image_url FROM part""",
)
def h13(m):
    return m.raw("part").select("p_partkey", claims.image_url(F.when(F.col("p_size") > 25, F.col("p_name"))).alias("image_url"))


_HEADER = r"""WITH t AS (SELECT doc_id, regexp_replace(text, '\r\n?', chr(10), 'g') AS x FROM documents),
    cut AS (SELECT doc_id, x, instr(x, 'The') AS mark, string_split(substr(x, instr(x, 'The')), chr(10))[2:] AS rest FROM t),
    keep AS (SELECT doc_id, x, mark, rest, list_position(list_transform(rest, lambda l: (NOT regexp_matches(l, '^\s*$')
      AND NOT regexp_matches(l, 'on\.\s*$'))), true) AS k FROM cut)
    SELECT doc_id, CASE WHEN mark = 0 THEN x WHEN k IS NULL OR k = 0 THEN '' ELSE array_to_string(rest[k:], chr(10)) END AS body FROM keep"""


@check("h18_strip_header", _HEADER)
def h18(m):
    return _docs(m).select("doc_id", T.strip_header(F.col("text"), marker="The", leftover="on.").alias("body"))


@check("h19_sections", "SELECT doc_id, text || chr(10) || text AS body FROM documents")
def h19(m):
    marked = F.concat(F.lit("["), "source", F.lit("]\n"), "text", F.lit("\n[Chorus 2]\n"), "text", F.lit("\n[Outro]"))
    return m.raw("documents").select("doc_id", F.regexp_replace(T.strip_sections(marked), r"\n\z", "").alias("body"))


@check(
    "h20_basic_stats",
    f"""SELECT doc_id, {O.fill(O.WORDS, 'text')} AS word_count, {O.fill(O.LINES, 'text')} AS line_count, {O.fill(O.CHARS, 'text')} AS char_count FROM documents""",
)
def h20(m):
    stats = m.raw("documents").select("doc_id", metrics.basic_stats(F.col("text")).alias("s"))
    return stats.select("doc_id", "s.word_count", "s.line_count", "s.char_count")


@check("h21_readability", f"WITH {O.readability('documents', 'doc_id')} SELECT doc_id, round(readability_score, 6) AS readability_score FROM readability")
def h21(m):
    scored = metrics.readability(F.col("text"))
    return _docs(m).select("doc_id", F.round(scored, 6).alias("readability_score"))


@check("h22_sentiment", f"WITH {O.sentiment('documents', 'doc_id')} SELECT doc_id, sentiment_score FROM sentiment")
def h22(m):
    return _docs(m).select("doc_id", sentiment.compound("text", STANDIN_RULES).alias("sentiment_score"))


@check("h23_lexical_density", f"WITH {O.density('documents', 'doc_id')} SELECT doc_id, lexical_density FROM density")
def h23(m):
    return _docs(m).select("doc_id", metrics.lexical_density(F.col("text")).alias("lexical_density"))
