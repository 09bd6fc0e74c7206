"""DuckDB SQL for the operators that SQL can express."""

from tessera.llm.licenses import RULES, SENTENCES, pattern

#: Words of a text, as ``common.words`` has them.
_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

OP1 = rf"""
WITH sized AS (SELECT doc_id, source, {_WORDS}::BIGINT AS size,
                      coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '') AS own FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT source, source_size, 3.0 * source_size AS cap,
                  1.0 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS w FROM per),
-- sources fill up in order of cap over weight: the level is the first one that fills no further source
ordered AS (SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS k FROM ranked),
levels AS (SELECT k, cap, w,
                  (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN
                       UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                  / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
           FROM ordered),
level AS (SELECT coalesce(arg_min(level, k) FILTER (WHERE level * w <= cap), 1e300) AS level FROM levels),
targets AS (SELECT source, source_size, least(cap::DOUBLE, level * w)::DOUBLE AS target
            FROM ranked, level),
rated AS (SELECT doc_id, size, source_size, target,
                 CASE WHEN source_size > 0 THEN target / source_size ELSE 1.0 END AS rate,
                 ('0x' || substr(md5('mix:' || own), 1, 8))::BIGINT
                     / 4294967296.0 AS draw
          FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       ((floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM rated
"""

_STRIP = r"trim({}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, {_LOWER.format(_STRIP.format('line'))} AS key FROM lines),
frequent AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
             GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.keeper AS dropped
           FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _values(pairs: list[tuple[str, str]]) -> str:
    return ", ".join("('" + a + "', '" + b + "')" for a, b in pairs)


OP4 = rf"""
WITH known(id, sentence) AS (VALUES {_values(SENTENCES)}),
rules(ids, license) AS (VALUES {_values(RULES)}),
texts AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS t, row_number() OVER () AS r FROM documents),
cut AS (SELECT r, string_split(regexp_replace(t, '([.!?])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), chr(10)) AS l
        FROM texts),
sentences AS (SELECT r, unnest(l) AS s, generate_subscripts(l, 1) AS pos FROM cut),
normal AS (SELECT r, pos, trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')) AS s FROM sentences),
coded AS (SELECT r, string_agg(coalesce(id, ' '), '' ORDER BY pos) AS ids
          FROM normal LEFT JOIN known ON s = sentence WHERE s <> '' GROUP BY r),
matched AS (SELECT r, ids, regexp_extract_all(ids, '{pattern()}') AS m FROM coded),
named AS (SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses
          FROM (SELECT r, unnest(m) AS ids FROM matched) JOIN rules USING (ids) GROUP BY r)
SELECT doc_id, length(replace(coalesce(ids, ''), ' ', ''))::BIGINT AS n_sentences,
       coalesce(len(m), 0)::BIGINT AS n_matches, coalesce(licenses, '') AS licenses
FROM texts LEFT JOIN matched USING (r) LEFT JOIN named USING (r)
"""

OP6 = """
WITH RECURSIVE vecs AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM vecs a JOIN vecs b
  ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(v, w) AS (SELECT a, b FROM links UNION SELECT r.v, l.b FROM reach r JOIN links l ON r.w = l.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least_of AS (SELECT v, min(w) AS w FROM reach GROUP BY v)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(w, vec_id)) AS component_id,
       vec_id <= coalesce(w, vec_id) AS kept
FROM embeddings LEFT JOIN counts ON vec_id = a LEFT JOIN least_of ON vec_id = v
"""

OP11 = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, range(1, 5) AS t(m)),
counts AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
           FROM grams GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1),
cuts AS (SELECT lang, phrase, k, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1:m], ' ') AS q, a
         FROM cand, range(1, 4) AS t(k) WHERE k < m),
ranked AS (SELECT c.lang, phrase, a, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score, k
           FROM cuts c JOIN (SELECT lang, phrase AS p, f FROM counts) x USING (lang, p)
                JOIN (SELECT lang, phrase AS q, f FROM counts) y USING (lang, q)),
lowest AS (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_of AS (SELECT DISTINCT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, a AS longer
             FROM cand, range(2, 4) AS t(s), range(1, 4) AS u(i) WHERE s < m AND i + s - 1 <= m),
gone AS (SELECT DISTINCT c.lang, c.phrase FROM cand c JOIN inner_of o ON c.lang = o.lang AND c.phrase = o.phrase
         WHERE 100::HUGEINT * longer >= 80::HUGEINT * c.a),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
           FROM lowest ANTI JOIN gone USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM placed JOIN sizes USING (lang) WHERE rank <= 2000
"""

ORACLE = {"op1_mix_sources": OP1, "op3_line_dedup": OP3, "op4_license_scan": OP4,
          "op6_embedding_dedup": OP6, "op11_phrases": OP11}
