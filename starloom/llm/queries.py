"""The operators as queries over their whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.llm.fingerprints import edited_fingerprints
from starloom.llm.language_crf import languages
from starloom.llm.ngram_jaccard import jaccard_links
from starloom.llm.orc_tokens import checksums, read_tokens, write_tokens
from starloom.llm.packing import pieces
from starloom.llm.piece_viterbi import round_trip
from starloom.llm.prefix_trie import shared_openings, trie_nodes, turn_lists
from starloom.llm.quality_ledger import BASE_RULES, DEFAULT, POLICIES, RULES, mask, verdicts
from starloom.llm.runtime import prepare, table
from starloom.llm.secret_scan import listed, scan
from starloom.llm.subspace_join import near_vectors
from starloom.llm.substring_dedup import remove_repeats
from starloom.llm.toxicity import toxicity
from starloom.llm.variant_trie import corpus_words, spelling_variants
from starloom.session import scratch_path

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(name):
    def register(fn):
        def run(spark, sf_dir):
            return fn(prepare(spark), sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return register


@query("op8_document_fingerprints")
def op8(spark, sf_dir):
    """MinHash fingerprints of each text and of its edited text."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op1_ngram_jaccard_join")
def op1(spark, sf_dir):
    """Class and number of links of each document at a Jaccard index of 0.8 over five-word shingles."""
    return jaccard_links(table(spark, sf_dir, "documents"))


ORACLES["op4_substring_dedup"] = r"""WITH w AS (SELECT row_number() OVER () AS r, doc_id,
      list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
  windows AS (SELECT r, doc_id, i, list_slice(words, i, i + 12) AS g FROM (SELECT *, unnest(range(1, len(words) - 11)) AS i FROM w)),
  gone AS (SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY g) AS low FROM windows) WHERE low < doc_id),
  covered AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS j FROM gone),
  kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS kept
           FROM (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM w) ANTI JOIN covered USING (r, j) GROUP BY r)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (r)"""


@query("op4_substring_dedup")
def op4(spark, sf_dir):
    """Words that remain when 13-word windows of smaller documents are removed."""
    made = remove_repeats(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_packing")
def op2(spark, sf_dir):
    """Pieces of documents in sequences of 1024 ids."""
    return pieces(table(spark, sf_dir, "documents"))


@query("op5_orc_tokens")
def op5(spark, sf_dir):
    """Token ids written to ORC files in order of doc_id, and read back."""
    path = scratch_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return checksums(read_tokens(spark, path))


@query("op10_sentencepiece")
def op10(spark, sf_dir):
    """SentencePiece ids of each text, decoded again."""
    return round_trip(table(spark, sf_dir, "documents"))


@query("op3_toxicity")
def op3(spark, sf_dir):
    """Toxicity score of each text."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_language_id")
def op6(spark, sf_dir):
    """Language of each text."""
    return languages(table(spark, sf_dir, "documents"))


_WORDS_SQL = r"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
  w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
               list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
  windows AS (SELECT r, i, [words[i], words[i + 1], words[i + 2]] AS g FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
  twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
  covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY r),
  m AS (SELECT doc_id, len(words) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
          length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
          len(lines) - len(list_distinct(lines)) AS n_dup_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals,
          length(regexp_replace(t, '[^!?]', '', 'g')) AS n_exclamations, coalesce(n, 0) AS n_repeat_words FROM w LEFT JOIN covered USING (r)),
"""


def _quality_sql() -> str:
    bits = " + ".join(f"CASE WHEN {rule} THEN {1 << k} ELSE 0 END" for k, rule in enumerate(RULES.values()))
    sole = " ".join(f"WHEN {1 << k} THEN '{name}'" for k, name in enumerate(RULES) if DEFAULT.mask >> k & 1)
    versions = ", ".join(f"CASE WHEN failed & {p.mask} = 0 THEN '{p.version}' END" for p in POLICIES)
    return f"""{_WORDS_SQL} bits AS (SELECT *, {bits} AS failed FROM m),
      judged AS (SELECT *, failed & {DEFAULT.mask} = 0 AS kept, CASE failed & {DEFAULT.mask} {sole} END AS sole_rule FROM bits),
      rules AS (SELECT sole_rule, count(*) AS n_only FROM judged WHERE sole_rule IS NOT NULL GROUP BY sole_rule)
      SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & {mask(*BASE_RULES)} <> 0 AS base_failed,
             kept, CAST(failed AS BIGINT) AS failed, '{DEFAULT.version}' AS policy, concat_ws(',', {versions}) AS kept_by, sole_rule,
             n_only, n_only + (SELECT count(*) FROM judged WHERE kept) AS n_kept_without FROM judged LEFT JOIN rules USING (sole_rule)"""


ORACLES["op7_quality_rules"] = _quality_sql()


@query("op7_quality_rules")
def op7(spark, sf_dir):
    """Measurements, failed rules and verdict of each text, and the ablation of the rule that alone rejects it."""
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    more = ("failed", "policy", "kept_by", "sole_rule", "n_only", "n_kept_without")
    return verdicts(table(spark, sf_dir, "documents")).select(*columns, *more)


@query("op9_secret_scans")
def op9(spark, sf_dir):
    """Secrets in each text."""
    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", listed().alias("spans"), "n_markov")


@query("op11_subspace_join")
def op11(spark, sf_dir):
    """Links and components of vectors at a cosine of 0.9."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


# crc32 as a fold over bytes; the table of 256 entries comes from its rule
_CRC_SQL = """crc AS (SELECT list_transform(range(256), lambda v: list_reduce(list_concat([v], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc32_sql(text: str) -> str:
    """crc32 of the UTF-8 bytes of an SQL text, where ``t`` is the table."""
    digits = f"hex(encode({text}))"
    values = f"list_transform(range(length({digits}) // 2), lambda k: ('0x' || substr({digits}, 2 * k + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {values}), lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8)), 4294967295)"


ORACLES["op12_prefix_trie"] = f"""WITH {_CRC_SQL},
  own AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
  h AS (SELECT conv_id, turns, ({_crc32_sql("conv_id::VARCHAR")} % 6)::INT AS h FROM own, crc),
  made AS (SELECT c.conv_id, list_concat(coalesce(list_slice(b.turns, 1, c.h), []), list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
           FROM h c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
  paths AS (SELECT conv_id, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM made),
  nodes AS (SELECT list_slice(turns, 1, depth) AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
              sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256 FROM paths GROUP BY ALL),
  sized AS (SELECT *, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(path[depth].text) END AS own_saved,
              list_slice(path, 1, depth - 1) AS above FROM nodes),
  children AS (SELECT above AS path, count(*) AS n_children FROM sized WHERE depth > 0 GROUP BY ALL),
  counted AS (SELECT s.*, coalesce(c.n_children, 0) AS n_children FROM sized s LEFT JOIN children c USING (path)),
  ups AS (SELECT list_slice(path, 1, unnest(range(depth + 1))) AS path, (n_children = 0)::INT AS leaf, own_saved FROM counted),
  sums AS (SELECT path, sum(leaf) AS n_leaves, sum(own_saved) AS saved_tokens FROM ups GROUP BY path)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
FROM counted c JOIN sums s USING (path) LEFT JOIN nodes p ON p.path = c.above AND c.depth > 0"""


@query("op12_prefix_trie")
def op12(spark, sf_dir):
    """Nodes of the trie of conversations that share the opening of their hundred."""
    return trie_nodes(shared_openings(turn_lists(table(spark, sf_dir, "conversations"))))


ORACLES["op13_spelling_variants"] = f"""WITH {_CRC_SQL},
  runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
           WHERE length(run) >= 5 GROUP BY ALL),
  hashed AS (SELECT run, n, {_crc32_sql("concat(doc_id, ':', run)")} AS h FROM runs, crc),
  words AS (SELECT CASE WHEN h % 97 = 0 THEN concat(left(run, (h % length(run))::INT), substr(run, (h % length(run))::INT + 2)) ELSE run END AS word, n FROM hashed),
  v AS (SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
  less AS (SELECT word, k, concat(left(word, k - 1), substr(word, k + 1)) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS k FROM v)),
  pairs AS (SELECT a.word AS a, b.word AS b FROM less a JOIN less b USING (k, rest) WHERE a.word <> b.word
            UNION SELECT l.word, v.word FROM less l JOIN v ON v.word = l.rest UNION SELECT v.word, l.word FROM less l JOIN v ON v.word = l.rest),
  best AS (SELECT a AS word, count(*) AS n_near, list(struct_pack(n := -n, w := b) ORDER BY -n, b)[1] AS top FROM pairs JOIN v ON v.word = b GROUP BY a),
  forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.n >= 2 * v.n THEN top.w END AS form, CASE WHEN -top.n >= 2 * v.n THEN -top.n END AS form_n
            FROM v LEFT JOIN best USING (word))
SELECT f.word, f.form, coalesce(r.root, f.word) AS root, f.n, f.n_near, f.form_n FROM forms f LEFT JOIN (
  WITH RECURSIVE way AS (SELECT word, form AS root FROM forms WHERE form IS NOT NULL
    UNION ALL SELECT way.word, forms.form FROM way JOIN forms ON forms.word = way.root WHERE forms.form IS NOT NULL)
  SELECT way.word, way.root FROM way JOIN forms ON forms.word = way.root WHERE forms.form IS NULL) r USING (word)"""


@query("op13_spelling_variants")
def op13(spark, sf_dir):
    """Words of the corpus with their more frequent spelling at one edit, and the last one of that way."""
    return spelling_variants(corpus_words(table(spark, sf_dir, "documents")))
