"""The operators bound to the given tables, with the settings they have in production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import chat, decontamination, licenses, lines, merkle, packing, prefix_trie, quality, ranked, simhash, toxicity, training, url_lists, warc
from millrace.session import materialize, scratch_path
from workload import Query
from workload.bindings import table


# What conversation -7 says in both its turns.
CONTROLS = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations in windows of 1,024 tokens, 256 of them history, read back from what was written."""
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROLS).alias("text"))
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    written = chat.windows(turns)
    new = F.expr("slice(turns, repeated + 1, size(turns))")
    read = written.withColumn("turns", chat.read_back(F.col("formatted"))).select(
        "conv_id", "window", F.length("formatted").cast("bigint").alias("chars"), new.alias("turns"),
        F.array_join(chat.under_mask(F.col("formatted"), F.col("loss")), "").alias("learnt"))
    parts = F.struct(
        "window", "learnt", F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"))
    whole = read.groupBy("conv_id").agg(
        F.sum(F.size("turns")).alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.count("*").alias("n_windows"), F.array_sort(F.collect_list(parts)).alias("parts"))
    said = F.array_join(F.transform("parts", lambda p: p["said"]), "")
    learnt = F.array_join(F.transform("parts", lambda p: p["learnt"]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"),
        F.length(learnt).cast("bigint").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"),
        "formatted_chars", "n_windows")


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _tokens_sql(column: str) -> str:
    return f"len(regexp_extract_all({column}, {_sql_text(chat.TOKEN)}))"


OP1_SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', {_sql_text(CONTROLS)}), (-7, 1, 'assistant', {_sql_text(CONTROLS)})),
measured AS (
    SELECT *, {_tokens_sql('role')} + {_tokens_sql('text')} + {chat.MARKS} AS cost,
           {len(chat.BEGIN + chat.END) + 2} + length(role) + length(regexp_replace(
               text, {_sql_text(chat.ESCAPED)}, '\\1\\\\\\2\\3', 'g')) AS chars
    FROM turns),
placed AS (
    SELECT *, row_number() OVER o - 1 AS place, CAST(sum(cost) OVER o AS BIGINT) - cost AS before
    FROM measured
    WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, sha256(text) ROWS UNBOUNDED PRECEDING)),
system AS (SELECT conv_id, cost AS system_cost, chars AS system_chars FROM placed
           WHERE place = 0 AND role = 'system'),
spread AS (
    SELECT p.*, coalesce(system_cost, 0) AS system_cost, before - coalesce(system_cost, 0) AS begins,
           greatest({chat.BUDGET - chat.HISTORY} - coalesce(system_cost, 0), 1) AS stride
    FROM placed p LEFT JOIN system USING (conv_id) WHERE NOT (place = 0 AND role = 'system')),
owned AS (
    SELECT *, 2 * (begins // stride) + CASE WHEN begins % stride + cost <= stride THEN 0 ELSE 1 END AS part
    FROM spread),
spans AS (
    SELECT conv_id, part, min(begins) AS starts, greatest(0, least({chat.HISTORY},
           {chat.BUDGET} - min(system_cost) - CAST(sum(cost) AS BIGINT))) AS room
    FROM owned GROUP BY conv_id, part),
repeats AS (
    SELECT conv_id, sum(chars) AS chars FROM owned JOIN spans USING (conv_id)
    WHERE begins < starts AND starts - begins <= room GROUP BY conv_id),
counts AS (SELECT conv_id, count(*) AS n FROM spans GROUP BY conv_id),
whole AS (
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(chars) FILTER (NOT (place = 0 AND role = 'system')) AS chars
    FROM placed GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
       CAST(coalesce(whole.chars, 0) + coalesce(repeats.chars, 0)
            + coalesce(system_chars, 0) * coalesce(n, 1) AS BIGINT) AS formatted_chars,
       coalesce(n, 1) AS n_windows
FROM whole LEFT JOIN repeats USING (conv_id) LEFT JOIN system USING (conv_id) LEFT JOIN counts USING (conv_id)
"""


# Lists derived from the pages' hosts: list, kind, which hosts (by the smallest page_id modulo a number), and the events'
# days: a first day and days after it, added and removed in turn. Domains have a list of their own.
LISTS = (
    ("ads", url_lists.BLOCK, 2, 13, (0, 40, 90)), ("malware", url_lists.BLOCK, 3, 7, (0,)),
    ("trusted", url_lists.ALLOW, 5, 11, (0, 100)),
)
DOMAIN_DAYS = (100, 130, 200)
FIRST_DAY = "2024-01-01"


def list_events(pages: DataFrame) -> DataFrame:
    """Dated entries for hosts and for the domains of their last two labels."""
    hosts = pages.select("page_id", url_lists.host(F.col("url")).alias("pattern")).where("pattern <> ''") \
        .groupBy("pattern").agg(F.min("page_id").alias("m"))
    first = F.lit(FIRST_DAY).cast("date")

    def events(name, kind, days):
        return F.transform(F.array(*days), lambda day, i: F.struct(
            F.lit(name).alias("list"), F.lit(kind).alias("kind"),
            F.when(i % 2 == 0, url_lists.ADDED).otherwise(url_lists.REMOVED).alias("event"),
            F.date_add(first, day).alias("on")))

    listed = F.concat(*[
        F.when(F.col("m") % share == 0, events(name, kind, [
            (F.col("m") * factor % 300).cast("int") + after for after in days])).otherwise(F.array())
        for name, kind, share, factor, days in LISTS])
    domains = hosts.select(F.substring_index("pattern", ".", -2).alias("pattern")).distinct().select(
        "pattern", F.inline(events("spam", url_lists.BLOCK, [F.lit(day) for day in DOMAIN_DAYS])))
    return hosts.select("pattern", F.inline(listed)).unionByName(domains)


def op2_url_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Every page, fetched on a day that its number tells, against the lists as they were on that day."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    fetched = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("page_id") * 37 % 360).cast("int"))
    return url_lists.evaluate(pages.withColumn("fetched_on", fetched), list_events(pages))


def _list_sql() -> str:
    parts = [
        f"SELECT pattern, '{name}' AS list, '{kind}' AS kind, {i} % 2 = 0 AS adds, "
        f"CAST(DATE '{FIRST_DAY}' + CAST(m * {factor} % 300 + {after} AS INTEGER) AS DATE) AS day "
        f"FROM hosts WHERE m % {share} = 0"
        for name, kind, share, factor, days in LISTS for i, after in enumerate(days)]
    parts += [
        f"SELECT DISTINCT regexp_extract(pattern, '[^.]*([.][^.]*)?$') AS pattern, 'spam' AS list, 'block' AS kind, "
        f"{i} % 2 = 0 AS adds, CAST(DATE '{FIRST_DAY}' + {day} AS DATE) AS day FROM hosts"
        for i, day in enumerate(DOMAIN_DAYS)]
    return " UNION ALL ".join(parts)


OP2_SQL = f"""
WITH captures AS (
    SELECT page_id, url, CAST(DATE '{FIRST_DAY}' + CAST(page_id * 37 % 360 AS INTEGER) AS DATE) AS fetched_on,
           lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#@]*@)?([^/:?#]+)', 2)) AS host FROM pages),
hosts AS (SELECT host AS pattern, min(page_id) AS m FROM captures WHERE host <> '' GROUP BY host),
events AS ({_list_sql()}),
entries AS (SELECT *, lead(day) OVER (PARTITION BY list, pattern ORDER BY day, adds) AS until FROM events),
matched AS (
    SELECT page_id, pattern, kind, list FROM captures JOIN entries
    ON (pattern = host OR pattern = url OR ends_with(host, '.' || pattern))
       AND adds AND fetched_on >= day AND (until IS NULL OR fetched_on < until)),
decided AS (
    SELECT page_id, max(struct_pack(l := length(pattern), allowed := kind = 'allow', pattern := pattern)) AS top,
           string_agg(DISTINCT list, ',' ORDER BY list) AS lists, count(*) AS n FROM matched GROUP BY page_id)
SELECT page_id, url, fetched_on, coalesce(NOT top.allowed, false) AS blocked, top.pattern AS rule,
       coalesce(lists, '') AS lists, coalesce(n, 0) AS n_entries
FROM captures LEFT JOIN decided USING (page_id)
"""


def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Every document that holds a benchmark item, with the passage and its edits."""
    return decontamination.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op4_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Trees of every text and of the text half replaced by the next one, and how alike they are."""
    beside = merkle.with_next_document(table(spark, sf, "documents"))
    trees = beside.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        merkle.tree(F.col("text")).alias("tree"), merkle.tree(F.col("edited")).alias("edited_tree"), "next_fingerprint")
    prints = trees.select(
        "doc_id", "n_chars", "edited_sha256", merkle.fingerprint(F.col("tree")).alias("fingerprint"),
        merkle.fingerprint(F.col("edited_tree")).alias("edited_fingerprint"), "next_fingerprint",
        F.size(merkle.changed(F.col("edited_tree"), F.col("tree"))).cast("bigint").alias("changed_paragraphs"))
    own = F.col("fingerprint")
    return prints.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        merkle.likeness(own, F.col("edited_fingerprint")).alias("near_edited"),
        merkle.likeness(own, F.col("next_fingerprint")).alias("near_next"), "changed_paragraphs")


def _tree_sql(column: str) -> str:
    def parts(value: str, pattern: str) -> str:
        return f"regexp_extract_all({value}, {_sql_text(pattern)})"

    def above(kind: str, digests: str) -> str:
        return f"sha256('{kind}' || array_to_string({digests}, ''))"

    leaves = f"list_transform({parts('p', merkle.PASSAGES)}, lambda x: sha256(x)[1:{merkle.LEAF}])"
    paragraphs = (f"list_transform(list_transform({parts('s', merkle.PARAGRAPHS)}, lambda p: {leaves}), lambda l: "
                  f"{{'digest': {above('p', 'l')}[1:{merkle.BRANCH}], 'leaves': l}})")
    return (f"list_transform(list_transform({parts(column, merkle.SECTIONS)}, lambda s: {paragraphs}), lambda o: "
            f"{{'digest': {above('s', 'list_transform(o, lambda x: x.digest)')}[1:{merkle.BRANCH}], 'paragraphs': o}})")


def _fingerprint_sql(tree: str) -> str:
    leaves = f"flatten(list_transform(flatten(list_transform({tree}, lambda x: x.paragraphs)), lambda x: x.leaves))"
    return (f"array_to_string(list_prepend(sha256('r' || array_to_string(list_transform({tree}, lambda x: x.digest), '')), "
            f"{leaves}), '-')")


def _likeness_sql(one: str, other: str) -> str:
    a, b = (f"list_distinct(string_split({x}, '-')[2:])" for x in (one, other))
    return (f"CASE WHEN {one} = {other} THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect({a}, {b})) "
            f"/ greatest(len({a}) + len({b}), 1) END")


OP4_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
beside AS (
    SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id DESC),
           first(text) OVER (ORDER BY doc_id DESC)) AS next FROM texts),
edited AS (SELECT *, substr(text, 1, length(text) - length(text) // 2)
                     || substr(next, 1, length(text) // 2) AS edited FROM beside),
trees AS (
    SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
           {_tree_sql('text')} AS tree, {_tree_sql('edited')} AS edited_tree, {_tree_sql('next')} AS next_tree
    FROM edited),
prints AS (
    SELECT doc_id, n_chars, edited_sha256, {_fingerprint_sql('tree')} AS fingerprint,
           {_fingerprint_sql('edited_tree')} AS edited_fingerprint, {_fingerprint_sql('next_tree')} AS next_fingerprint,
           list_transform(tree, lambda x: x.digest) AS sections,
           list_transform(flatten(list_transform(tree, lambda x: x.paragraphs)), lambda x: x.digest) AS paragraphs,
           edited_tree
    FROM trees)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
       {_likeness_sql('fingerprint', 'edited_fingerprint')} AS near_edited,
       {_likeness_sql('fingerprint', 'next_fingerprint')} AS near_next,
       CAST(len(list_filter(flatten(list_transform(list_filter(edited_tree, lambda s: NOT list_contains(sections, s.digest)),
           lambda s: s.paragraphs)), lambda p: NOT list_contains(paragraphs, p.digest))) AS BIGINT) AS changed_paragraphs
FROM prints
"""


def op6_simhash_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of three-word shingles and their classes at two differing bits or fewer."""
    found = simhash.fingerprints(table(spark, sf, "documents"), words=3)
    placed = simhash.classes(found, "doc_id", distance=2)
    return placed.select("doc_id", simhash.hexadecimal(F.col("bits")).alias("fingerprint"), "component_id")


def tokenizer_file(name: str) -> str:
    """Where the vocabulary lies; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def packed(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, tokenizer_file(packing.VOCABULARY), public_tokenizers.PATTERN)


def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of all documents in sequences of 1,024 tokens."""
    return packed(table(spark, sf, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the later copies of repeated runs of 50 words or more."""
    clean = lines.without_later_copies(table(spark, sf, "documents"))
    return clean.select(
        "doc_id", F.size("deleted_lines").cast("bigint").alias("n_deleted"),
        F.array_join(F.col("deleted_lines").cast("array<string>"), ",").alias("deleted_lines"),
        F.length("text").cast("bigint").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


OP8_SQL = rf"""
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
numbered AS (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS i FROM split),
counted AS (SELECT *, len(regexp_extract_all(line, '[^ 	

]+')) AS words FROM numbered),
summed AS (
    SELECT *, CAST(sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS total FROM counted),
spans AS (
    SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM summed a JOIN summed b
    ON a.doc_id = b.doc_id AND a.i <= b.i AND b.total - a.total + a.words >= {lines.LEAST_WORDS} GROUP BY ALL
    UNION
    SELECT b.doc_id, max(a.i) AS s, b.i AS e FROM summed a JOIN summed b
    ON a.doc_id = b.doc_id AND a.i <= b.i AND b.total - a.total + a.words >= {lines.LEAST_WORDS} GROUP BY b.doc_id, b.i),
begins AS (
    SELECT doc_id, CAST(sum(len(parts) + 1) OVER (ORDER BY doc_id) AS BIGINT) - len(parts) - 1 AS b FROM split),
runs AS (
    SELECT doc_id, s, e, b + s AS p, array_to_string(parts[s + 1:e + 1], chr(10)) AS run
    FROM spans JOIN split USING (doc_id) JOIN begins USING (doc_id)),
later AS (
    SELECT *, min(p) OVER (PARTITION BY run, e - s) AS first FROM runs),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS i FROM later WHERE p - first >= e - s + 1),
kept AS (
    SELECT n.doc_id, count(g.i) AS n_deleted,
           coalesce(string_agg(CAST(g.i AS VARCHAR), ',' ORDER BY n.i), '') AS deleted_lines,
           coalesce(string_agg(n.line, chr(10) ORDER BY n.i) FILTER (g.i IS NULL), '') AS text
    FROM numbered n LEFT JOIN gone g USING (doc_id, i) GROUP BY n.doc_id)
SELECT doc_id, n_deleted, deleted_lines, CAST(length(text) AS BIGINT) AS kept_chars, sha256(text) AS kept_sha256
FROM kept
"""


# From this score on a document counts as labelled 1.
PREDICTED = 0.7


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model | None:
    """Learnt from the labelled rows that are not held out."""
    train = F.coalesce(training.key_remainder(F.col("doc_id"), 3) != 1, F.lit(False))
    return training.fit(docs, labels, "toxic", train, toxicity.Model, toxicity.learn)


def _decided(scores: DataFrame, modulus: int, held: int) -> DataFrame:
    remainder = training.key_remainder(F.col("doc_id"), modulus)
    return scores.select(
        "doc_id", F.coalesce(remainder == held, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= PREDICTED, 1).otherwise(0).alias("predicted"))


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's quality, learnt from three quarters of the labels."""
    docs = table(spark, sf, "documents")
    train = F.coalesce(training.key_remainder(F.col("doc_id"), 4) != 2, F.lit(False))
    model = training.fit(docs, table(spark, sf, "labels"), "quality", train, quality.Model, quality.learn,
                         rows_per_class=1_500)
    return _decided(quality.score(docs, model), 4, 2)


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's toxicity, learnt from two thirds of the labels."""
    docs = table(spark, sf, "documents")
    model = toxicity_model(docs, table(spark, sf, "labels"))
    return _decided(toxicity.score(docs, model), 3, 1)


def op10_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Per document its phrases and labels; the notices found with errors add labels of their own."""
    scanned = licenses.scan(table(spark, sf, "documents"))
    found = F.col("findings")
    base = F.filter(found, lambda f: f["exact"])
    starts = F.transform(base, lambda f: f["first_word"])

    def joined(of):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda f: f["label"]))), ",")

    return scanned.select(
        "doc_id", "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(found).alias("labels"),
        F.coalesce(F.array_max(F.transform(found, lambda f: f["score"])), F.lit(0.0)).alias("score"),
        F.filter(found, lambda f: ~f["exact"]).alias("notices"),
    )


def _phrase_sql() -> str:
    """Places of each phrase: where its first word stands and the others follow."""
    parts = []
    for phrase, label in licenses.PHRASES:
        words = phrase.split()
        same = " AND ".join(f"words[i + {k}] = {_sql_text(word)}" for k, word in enumerate(words, 1))
        parts.append(f"SELECT d, i, {_sql_text(label)} AS label FROM places WHERE {same}")
    return " UNION ALL ".join(parts)


# The columns that the phrases decide; a test holds the query's against it. The notices' bounded errors are beyond SQL.
OP10_BASE_SQL = f"""
WITH docs AS (
    SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), {_sql_text(licenses.WORD)}) AS words FROM documents),
places AS (SELECT d, words, unnest(range(len(words))) AS i FROM docs),
found AS ({_phrase_sql()}),
told AS (
    SELECT d, count(*) AS n, min(i) AS low, max(i) AS high, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM found GROUP BY d)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, low AS first_word, high AS last_word,
       coalesce(labels, '') AS base_labels
FROM docs LEFT JOIN told USING (d)
"""


# A conversation begins with up to this many turns, less one, of the first of its five.
LENT, FAMILY = 9, 5


def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """The trie of all conversations, rebuilt so that each begins like the first of its five."""
    turns = materialize(prefix_trie.measured(table(spark, sf, "conversations")), "turns")
    keys = turns.select("conv_id").distinct()
    begins = F.crc32(F.col("conv_id").cast("string").cast("binary")) % LENT
    own = turns.where(F.col("place") > begins)
    lent = turns.where(F.col("place") < LENT).withColumnRenamed("conv_id", "_source")
    borrowed = keys.withColumn("_source", F.col("conv_id") - F.col("conv_id") % FAMILY).join(lent, "_source").where(
        F.col("place") <= begins).select(*own.columns)
    return prefix_trie.nodes(own.unionByName(borrowed), keys)


OP11_SQL = f"""
WITH turns AS (
    SELECT conv_id, md5(strlen(role) || ':' || role || text) AS digest, CAST(strlen(text) AS BIGINT) AS bytes,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
                              md5(strlen(role) || ':' || role || text)) AS place
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
    WHERE conv_id IS NOT NULL),
keys AS (
    SELECT conv_id, conv_id - conv_id % {FAMILY} AS source, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))), lambda crc, b: list_reduce(
               list_prepend(xor(crc, b), CAST(range(8) AS BIGINT[])),
               lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % {LENT} AS h
    FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
    SELECT conv_id, place, digest, bytes FROM turns JOIN keys USING (conv_id) WHERE place > h
    UNION ALL SELECT k.conv_id, place, digest, bytes FROM keys k JOIN turns t ON t.conv_id = k.source WHERE place <= h),
members AS (
    SELECT conv_id, row_number() OVER o AS d, md5(string_agg(digest, '') OVER o) AS node, bytes
    FROM rebuilt WINDOW o AS (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)
    UNION ALL SELECT conv_id, 0, '', 0 FROM keys),
stats AS (
    SELECT node, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM members GROUP BY node, d),
links AS (
    SELECT DISTINCT c.node, p.node AS parent FROM members c JOIN members p ON p.conv_id = c.conv_id AND p.d = c.d - 1),
families AS (SELECT parent AS node, count(*) AS n_children FROM links GROUP BY parent),
ends AS (
    SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
    FROM members JOIN (SELECT conv_id, max(d) AS d FROM members GROUP BY conv_id) USING (conv_id, d) GROUP BY node),
below AS (SELECT DISTINCT v.node AS top, u.node FROM members v JOIN members u ON u.conv_id = v.conv_id AND u.d >= v.d),
subtrees AS (
    SELECT top AS node, count(*) FILTER (n_children IS NULL) AS n_leaves,
           CAST(sum((n_convs - 1) * bytes) AS BIGINT) AS saved_tokens
    FROM below JOIN stats USING (node) LEFT JOIN families USING (node) GROUP BY top)
SELECT s.conv_id, s.depth, p.conv_id AS parent_conv_id, s.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM stats s JOIN subtrees USING (node) LEFT JOIN families USING (node) LEFT JOIN ends USING (node)
LEFT JOIN links USING (node) LEFT JOIN stats p ON p.node = links.parent
"""


def op12_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Every page written to archives without repeated payloads, and read back from them."""
    path = scratch_path(spark, "archives")
    warc.write_archives(warc.from_pages(table(spark, sf, "pages")), path)
    read = warc.resolved(warc.read_archives(spark, path))
    return read.select(
        F.col("key").cast("bigint").alias("page_id"), F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"),
        F.col("original.key").cast("bigint").alias("refers_to"))


OP12_SQL = f"""
WITH hashed AS (
    SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS hex
    FROM (SELECT page_id, coalesce(html, '') AS html FROM pages)),
coded AS (
    SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr(
               '{warc.BASE32}', 1 + CAST((('0x' || substr(hex, 1 + 5 * CAST(i // 4 AS INTEGER), 5))::BIGINT
               >> (5 * (3 - CAST(i % 4 AS INTEGER)))) & 31 AS INTEGER), 1)), '') AS payload_digest
    FROM hashed),
placed AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original,
           row_number() OVER (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST) AS place FROM coded)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN original END AS refers_to
FROM placed
"""


def op13_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return ranked.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def _terms_sql(column: str) -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (f"regexp_extract_all(translate(coalesce({column}, ''), '{letters}', '{letters.lower()}'), "
            f"{_sql_text(ranked.TERM)})")


OP13_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {_terms_sql('text')} AS terms FROM documents),
totals AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0),
asked AS (SELECT DISTINCT item_id, unnest({_terms_sql('text')}) AS term FROM benchmark),
postings AS (
    SELECT d, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
    FROM (SELECT d, doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
    FROM postings, totals GROUP BY term, n_docs),
scored AS (
    SELECT item_id, d, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT)
           AS score
    FROM postings JOIN weights USING (term) JOIN asked USING (term), totals GROUP BY item_id, d, doc_id),
places AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank,
           doc_id, score
    FROM scored WHERE score > 0)
SELECT * FROM places WHERE rank <= {ranked.BEST}
"""


QUERIES = {
    "op1_chat_format": Query(op1_chat_format, OP1_SQL),
    "op2_url_lists": Query(op2_url_lists, OP2_SQL),
    "op3_decontamination": Query(op3_decontamination),
    "op4_fingerprints": Query(op4_fingerprints, OP4_SQL),
    "op5_quality": Query(op5_quality),
    "op6_simhash_classes": Query(op6_simhash_classes),
    "op7_packing": Query(op7_packing),
    "op8_line_dedup": Query(op8_line_dedup, OP8_SQL),
    "op9_toxicity": Query(op9_toxicity),
    "op10_license_scan": Query(op10_license_scan),
    "op11_prefix_trie": Query(op11_prefix_trie, OP11_SQL),
    "op12_warc": Query(op12_warc, OP12_SQL),
    "op13_ranked_search": Query(op13_ranked_search, OP13_SQL),
}
