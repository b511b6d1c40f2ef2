"""Queries of sources and sinks: tables are written to the work folder, read back, and compared with SQL on the source."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..adapters import IV, SBJ, fresh, intervals, subjects, table
from ..operators import classify as cl
from ..sources import files, sinks
from . import classes

MERGED = """o AS (SELECT *, max(pos + len) OVER (PARTITION BY seq_id ORDER BY pos, len ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM part),
 g AS (SELECT *, sum(CASE WHEN e IS NULL OR pos > e THEN 1 ELSE 0 END) OVER (PARTITION BY seq_id ORDER BY pos, len) AS g FROM o),
 m AS (SELECT seq_id, min(pos) AS pos, max(pos + len) - min(pos) AS len FROM g GROUP BY seq_id, g)"""


def _seqs(s, d):
    return subjects(s, d).select(F.col("oid").cast("string").alias("seq_id"), "seq", "tax_id")


def _fasta(s, d):
    path = fresh(s, "fasta")
    files.write_fasta(_seqs(s, d).select(F.col("seq_id").alias("id"), "seq"), path)
    return files.read_fasta(s, path)


def _text(s, df, name, **options):
    """The table as tab-separated text in the work folder."""
    path = fresh(s, name)
    line = F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns))
    df.select(line.alias("value")).write.options(**options).text(path)
    return path


def _tsv(s, d):
    rows = table(s, d, "supplier").select("s_suppkey", F.concat(F.lit("  "), "s_name", F.lit(" ")).alias("s_name"), "s_nationkey")
    path = _text(s, rows.withColumn("s_suppkey", F.when(F.col("s_suppkey") % 7 == 0, F.concat(F.lit("#"), "s_suppkey")).otherwise(F.col("s_suppkey").cast("string"))), "tsv")
    return files.read_tsv(s, path, "s_suppkey long, s_name string, s_nationkey int")


def _taxa(s, d):
    n = F.col("n_nationkey")
    rows = table(s, d, "nation").select(
        (n + 1).alias("tax_id"), F.concat("n_name", F.when(n % 3 == 0, " mitochondrion").when(n % 3 == 1, " plastid").otherwise("")).alias("species"),
        F.lower("n_name").alias("common_name"), F.lit("x").alias("blast_div"), F.when(n % 5 == 0, "synthetic").otherwise("anml:fishes").alias("div"))
    return files.read_taxa(s, _text(s, rows, "taxa"))


def _locations(s, d):
    i = intervals(s, d).select("seq_id", "pos", (F.col("pos") + F.col("len") - 1).alias("to"))
    whole = i.filter("seq_id % 10 = 0").select("seq_id", F.lit(".").alias("pos"), F.lit(".").alias("to"))
    rows = i.select("seq_id", F.col("pos").cast("string").alias("pos"), F.col("to").cast("string").alias("to")).unionByName(whole)
    return files.read_locations(s, _text(s, rows, "locs")).select("seq_id", "pos", F.coalesce("len", F.lit(-1)).alias("len"))


def _metaline(s, d):
    path = fresh(s, "meta")
    sinks.write_table(table(s, d, "region"), path, "table of regions", 2, 1, rows=5)
    m = files.check_metaline(path, s, "table of regions", 2)
    more = files.extend_metaline(files.make_metaline(m["name"], m["major"], m["minor"], **m["content"]), build="2024-01-01")
    return s.createDataFrame([(m["name"], m["major"], m["minor"], m["content"]["rows"], more)], "name string, major int, minor int, n int, line string")


def _store(s, d):
    path = fresh(s, "store")
    files.chunks(_seqs(s, d), 1000, 0).write.parquet(path)
    back = s.read.parquet(path).groupBy("seq_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "seq"))), lambda x: x["seq"]), "").alias("seq"))
    return back.select("seq_id", F.length("seq").cast("long").alias("n"), F.md5("seq").alias("digest"))


def _names(s, d):
    return table(s, d, "nation").select((F.col("n_nationkey") + 1).alias("tax_id"), F.col("n_name").alias("species"), F.lower("n_name").alias("common_name"), F.lit("b").alias("blast_div"), F.concat(F.lit("anml:"), F.col("n_regionkey").cast("string")).alias("div"))


def _fetch(s, d):
    q = _seqs(s, d)
    n = F.col("oid")
    at = subjects(s, d).select(n.cast("string").alias("seq_id"), (n % 50 + 1).cast("long").alias("pos"), F.when(n % 4 > 0, n % 30 + 1).cast("long").alias("len"))
    return files.fetch(q, at).select("id", F.md5("seq").alias("digest"))


def _report_rows(s, d):
    r = classes.records(s, d)
    r = r.select("seq_id", "len", "xp", "lc", "co", (F.col("k") % 9).cast("int").alias("n"), F.lit(0).alias("xc"), "cvg_by_all", F.lit("name").alias("tax_name"), "taxa")
    return sinks.report_columns(r)


def _line(df):
    return df.select(F.col("seq-id").alias("seq_id"), F.concat_ws("\t", *(F.col(f"`{c}`") for c in df.columns)).alias("line"))


TAXON = lambda i: "||".join(f"chr(9) || coalesce(CAST(taxa[{i}].{f} AS VARCHAR), '')" for f in ("tax_id", "div", "cvg_by_div", "cvg_by_tax", "score")) + "|| chr(9) || '|'"
LINE = "seq_id || chr(9) || len || chr(9) || concat_ws(',', xp, lc, co, k % 9, 0) || chr(9) || cvg_by_all || chr(9) || '|' || chr(9) || 'name' ||" + "||".join(map(TAXON, range(1, 5)))


def _report_scan(s, d):
    path = fresh(s, "report")
    sinks.write_table(_report_rows(s, d), path, "report", 1)
    return files.read_report(s, path).select("seq_id", F.col("len").cast("long").alias("len"), F.col("xp").cast("long").alias("xp"), "cvg_by_all", F.size("taxa").cast("long").alias("taxa"), F.get("taxa", 0)["div"].alias("first"))


def _classified(s, d):
    r = classes.records(s, d).withColumns({"xc": F.lit(0), "tax_name": F.lit("name")})
    c = sinks.classified_columns(cl.classify(r, *classes.SETTINGS[0][1:3], 0.2))
    return c.select(F.col("seq-id").alias("seq_id"), "reserved", "result", "result_div", "div_pct_cvg")


def _actions(s, d):
    k = F.col("o_orderkey")
    return table(s, d, "orders").select(
        F.concat(F.lit("s"), k.cast("string"), F.when(k % 4 == 0, "{TILDE}x").otherwise("")).alias("seq_id"), (k % 90 + 1).alias("pos"), (k % 40 + 10).alias("len"),
        (k % 40 + 200).alias("seq_len"), F.when(k % 2 == 0, "TRIM").otherwise("EXCLUDE").alias("action"), F.lit("prok:bacteria").alias("div"), (k % 101).alias("agg_cov"), F.lit("E. coli").alias("top_tax_name"))


def _actions_scan(s, d):
    eight = fresh(s, "actions8")
    sinks.write_table(sinks.action_columns(_actions(s, d)), eight, "actions", 2)
    a = _actions(s, d).filter("pos % 3 = 0")
    five = a.select("seq_id", "seq_len", "action", F.when(F.col("pos") % 2 == 0, F.concat(F.col("pos").cast("string"), F.lit(".."), (F.col("pos") + 4).cast("string"), F.lit(",100..110"))).otherwise("").alias("r"), F.lit("note").alias("x"))
    return files.read_actions(s, eight).unionByName(files.read_actions(s, _text(s, five, "actions5"))).groupBy("seq_id", "pos", "len", "action").agg(F.count("*").alias("n"))


ACT = """a AS (SELECT 's' || o_orderkey || CASE WHEN o_orderkey % 4 = 0 THEN '{TILDE}x' ELSE '' END AS seq_id, o_orderkey % 90 + 1 AS pos, o_orderkey % 40 + 10 AS len,
 o_orderkey % 40 + 200 AS seq_len, CASE WHEN o_orderkey % 2 = 0 THEN 'TRIM' ELSE 'EXCLUDE' END AS action, o_orderkey % 101 AS cov FROM orders)"""


def _division(s, d):
    m = s.createDataFrame([("AFRICA", "anml:a"), ("ASIA", "plnt:b"), ("FRANCE", "prok:c"), ("CHINA", "virs:d")], "name string, div string")
    n = table(s, d, "nation").join(F.broadcast(table(s, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return files.with_division(n.select("n_nationkey", "n_name", "r_name"), m, "n_name", "r_name").select("n_nationkey", "div")


def _gz(s, d):
    return _text(s, table(s, d, "nation").select("n_nationkey", "n_name"), "gz", compression="gzip")


def _manifest(s, d):
    one = _gz(s, d)
    listed = fresh(s, "manifest")
    names = s.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(one).select("path")
    names.select(F.col("path").alias("value")).write.text(listed)
    return files.read_manifest_files(s, listed).select(F.split("value", "\t")[0].cast("int").alias("n_nationkey"), F.split("value", "\t")[1].alias("n_name"))


def _subject_set(s, d):
    rows = _seqs(s, d).select("seq_id", "tax_id").join(F.broadcast(_names(s, d)), "tax_id")
    taxa, ids = files.subject_set(s, _text(s, rows.select("seq_id", "tax_id", "species", "common_name", "blast_div", "div"), "subjects"))
    return ids.join(taxa, "tax_id").groupBy("tax_id", "species", "div").agg(F.count("*").alias("ids"))


def _places(s, d):
    n = F.col("oid")
    k = F.explode(F.sequence(F.lit(0), F.lit(3)))
    return subjects(s, d).select(n, k.alias("j")).select(n.cast("string").alias("seq_id"), (n % 20 + 1 + F.col("j") * (n % 40)).cast("long").alias("pos"), (n % 15 + 5).cast("long").alias("len"))


MASK = f"""WITH {SBJ}, part AS (SELECT CAST(oid AS VARCHAR) AS seq_id, oid % 20 + 1 + j * (oid % 40) AS pos, oid % 15 + 5 AS len FROM sbj, range(0, 4) AS t(j)),
 letters AS (SELECT CAST(oid AS VARCHAR) AS seq_id, unnest(string_split(seq, '')) AS x, generate_subscripts(string_split(seq, ''), 1) AS i FROM sbj WHERE length(seq) > 0),
 y AS (SELECT l.seq_id, i, x, bool_or(p.seq_id IS NOT NULL) AS m FROM letters l LEFT JOIN part p ON l.seq_id = p.seq_id AND i >= p.pos AND i < p.pos + p.len GROUP BY ALL)
SELECT seq_id, md5(string_agg(CASE WHEN m THEN lower(x) ELSE x END, '' ORDER BY i)) AS soft, md5(string_agg(CASE WHEN m THEN 'N' ELSE x END, '' ORDER BY i)) AS hard FROM y GROUP BY seq_id"""


def _mask(s, d):
    q = _seqs(s, d).filter("length(seq) > 0")
    soft, hard = (files.mask(q, _places(s, d), h).select("seq_id", F.md5("seq").alias(n)) for h, n in ((False, "soft"), (True, "hard")))
    return soft.join(hard, "seq_id")


def _stored_index(s, d):
    path = fresh(s, "index")
    n = table(s, d, "lineitem").select(F.col("l_partkey").alias("word"), F.col("l_orderkey").alias("oid"), F.col("l_linenumber").alias("pos"))
    files.store_index(n, path, 16)
    return files.load_index(s, path, [1, 7, 100, 1999]).groupBy("word").agg(F.count("*").alias("n"), F.sum("oid").alias("oids"))


def register(query) -> None:
    query("fasta_scan", f"WITH {SBJ} SELECT CAST(oid AS VARCHAR) AS seq_id, length(seq) AS n, md5(seq) AS digest FROM sbj")(
        lambda s, d: files.assert_unique_ids(_fasta(s, d)).select("seq_id", F.length("seq").cast("long").alias("n"), F.md5("seq").alias("digest")))
    query("fasta_chunks", f"WITH {SBJ}, c AS (SELECT oid, seq, unnest(range(0, greatest(length(seq), 1), 1000)) AS \"offset\" FROM sbj) SELECT CAST(oid AS VARCHAR) AS seq_id, \"offset\", md5(seq[\"offset\" + 1:\"offset\" + 1100]) AS digest FROM c")(
        lambda s, d: files.chunks(_seqs(s, d), 1000, 100).select("seq_id", F.col("offset").cast("long").alias("offset"), F.md5("seq").alias("digest")))
    query("tsv_scan", "SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_suppkey % 7 <> 0")(_tsv)
    query("split_fields", "SELECT p_partkey, string_split(p_partkey || '|' || p_brand || '|' || p_size, '|')[2] AS second, len(string_split(p_type, ' ')) AS parts FROM part")(
        lambda s, d: table(s, d, "part").select("p_partkey", F.split(F.concat_ws("|", F.col("p_partkey").cast("string"), "p_brand", F.col("p_size").cast("string")), r"\|")[1].alias("second"), F.size(F.split("p_type", " ")).cast("long").alias("parts")))
    query("taxa_scan", "SELECT n_nationkey + 1 AS tax_id, n_name AS species, lower(n_name) AS common_name, 'x' AS blast_div, CASE WHEN n_nationkey % 5 = 0 THEN 'synt:synthetic' ELSE 'anml:fishes' END AS div FROM nation UNION ALL SELECT 0, 'NULL', 'NULL', 'NULL', 'NULL'")(_taxa)
    query("locations_scan", f"WITH {IV}, part AS (SELECT CAST(seq_id AS VARCHAR) AS seq_id, pos, len FROM iv WHERE seq_id % 10 <> 0), {MERGED} SELECT seq_id, pos, CAST(len AS BIGINT) AS len FROM m UNION ALL SELECT DISTINCT CAST(seq_id AS VARCHAR), 1, -1 FROM iv WHERE seq_id % 10 = 0")(_locations)
    query("id_map_scan", f"WITH {SBJ} SELECT DISTINCT CAST(oid % 100 AS VARCHAR) AS seq_id, tax_id FROM sbj")(
        lambda s, d: files.read_id_map(s, _text(s, subjects(s, d).select(F.col("oid") % 100, "tax_id"), "ids")))
    query("metaline_round_trip", """SELECT 'table of regions' AS name, 2 AS major, 1 AS minor, 5 AS n, '##[["table of regions", 2, 1], {"rows": 5, "build": "2024-01-01"}]' AS line""")(_metaline)
    query("sequence_store", f"WITH {SBJ} SELECT CAST(oid AS VARCHAR) AS seq_id, length(seq) AS n, md5(seq) AS digest FROM sbj")(_store)
    query("sequence_info", f"WITH {SBJ} SELECT CAST(oid AS VARCHAR) AS seq_id, length(seq) AS length, tax_id, n_name AS species, lower(n_name) AS common_name, 'b' AS blast_div, 'anml:' || n_regionkey AS div FROM sbj JOIN nation ON tax_id = n_nationkey + 1")(
        lambda s, d: sinks.sequence_info(_seqs(s, d), F.broadcast(_names(s, d))))
    query("index_meta", f"WITH {SBJ} SELECT count(*) AS seqs, round(CAST(sum(length(seq)) AS DOUBLE) / 1e9, 6) AS \"Gbp\" FROM sbj JOIN nation ON tax_id = n_nationkey + 1")(
        lambda s, d: sinks.index_meta(sinks.sequence_info(_seqs(s, d), F.broadcast(_names(s, d)))))
    query("fetch_ranges", f"WITH {SBJ}, a AS (SELECT CAST(oid AS VARCHAR) AS s, seq, oid % 50 + 1 AS pos, CASE WHEN oid % 4 > 0 THEN oid % 30 + 1 END AS n FROM sbj) SELECT CASE WHEN n IS NULL THEN s ELSE s || ':' || pos || '-' || (pos + n - 1) END AS id, md5(substr(seq, pos, CAST(coalesce(n, greatest(0, length(seq) - pos + 1)) AS BIGINT))) AS digest FROM a")(_fetch)
    query("report_rows", f"WITH {classes.REC} SELECT seq_id, {LINE} AS line FROM rec")(lambda s, d: _line(_report_rows(s, d)))
    query("report_scan", f"WITH {classes.REC} SELECT seq_id, len - k % 9 AS len, xp, cvg_by_all, len(taxa) AS taxa, taxa[1].div AS first FROM rec")(_report_scan)
    pct = "CAST(CAST(floor(coalesce(list_filter(taxa, lambda x: x.div = result_div)[1].cvg_by_div, 0) / greatest(len, 1) * 100 + 0.5) AS BIGINT) AS VARCHAR)"
    query("classified_rows", f"WITH {classes.REC}, c AS ({classes._classes(*classes.SETTINGS[0])}) SELECT seq_id, 'n/a' AS reserved, result, result_div, {pct} AS div_pct_cvg FROM c JOIN rec USING (seq_id)")(_classified)
    query("action_rows", f"WITH {ACT} SELECT replace(seq_id, '{{TILDE}}', '~') AS seq_id, CAST(pos AS VARCHAR) AS start_pos, CAST(pos + len - 1 AS VARCHAR) AS end_pos, CAST(seq_len AS VARCHAR) AS seq_len, action, 'prok:bacteria' AS div, CAST(cov AS VARCHAR) AS agg_cont_cov, 'E. coli' AS top_tax_name FROM a")(
        lambda s, d: sinks.action_columns(_actions(s, d)))
    query("actions_scan", f"WITH {ACT}, f AS (SELECT seq_id, action, pos, seq_len FROM a WHERE pos % 3 = 0), u AS (SELECT replace(seq_id, '{{TILDE}}', '~') AS seq_id, pos, len, action FROM a UNION ALL SELECT seq_id, pos, 5, action FROM f WHERE pos % 2 = 0 UNION ALL SELECT seq_id, 100, 11, action FROM f WHERE pos % 2 = 0 UNION ALL SELECT seq_id, 1, seq_len, action FROM f WHERE pos % 2 = 1) SELECT seq_id, pos, len, action, count(*) AS n FROM u GROUP BY ALL")(_actions_scan)
    query("name_division", "SELECT n_nationkey, CASE n_name WHEN 'FRANCE' THEN 'prok:c' WHEN 'CHINA' THEN 'virs:d' ELSE CASE r_name WHEN 'AFRICA' THEN 'anml:a' WHEN 'ASIA' THEN 'plnt:b' ELSE 'unkn:unknown' END END AS div FROM nation JOIN region ON n_regionkey = r_regionkey")(_division)
    query("gz_lookup", "SELECT n_nationkey || chr(9) || n_name AS value FROM nation WHERE regexp_matches(n_name, '[0-4]$')")(lambda s, d: files.lookup(s, _gz(s, d), r"[0-4]$"))
    query("manifest_of_files", "SELECT n_nationkey, n_name FROM nation")(_manifest)
    query("subject_set", f"WITH {SBJ} SELECT tax_id, n_name AS species, 'anml:' || n_regionkey AS div, count(*) AS ids FROM sbj JOIN nation ON tax_id = n_nationkey + 1 GROUP BY ALL")(_subject_set)
    query("masked_sequences", MASK)(_mask)
    query("stored_index", "SELECT l_partkey AS word, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS oids FROM lineitem WHERE l_partkey IN (1, 7, 100, 1999) GROUP BY 1")(_stored_index)
