"""SQL for an independent engine, for the queries that SQL can express."""

from __future__ import annotations

from emberfold.llm import chat_parts as cp
from emberfold.llm import chosen_path as paths
from emberfold.llm import jaccard_join as jj
from emberfold.llm import line_simjoin as ls
from emberfold.llm import risk_quality as rq
from emberfold.llm import source_schedule as ss

WORD = r"[^\x20\x09-\x0D]+"


def _quality(kept_only: bool = False) -> str:
    """Counts, score and verdict of ``documents``, or the kept rows of it."""
    ref = rq.REFERENCES
    out = (
        "SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars FROM verdict v JOIN d USING (rid) WHERE v.kept"
        if kept_only
        else """SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
                round(score, 9) AS score FROM verdict"""
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, *, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '{WORD}') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM d),
grams AS (SELECT rid, i, array_to_string(words[i:i+4], ' ') AS g
          FROM (SELECT rid, words, unnest(generate_series(1, len(words) - 4)) AS i FROM w WHERE len(words) >= 5)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1),
repeats AS (SELECT rid, sum(step) AS n FROM (
              SELECT rid, least(5, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 5)) AS step FROM twice)
            GROUP BY rid),
m AS (SELECT d.rid, d.doc_id, d.lang AS stratum, len(words)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
        len(lines) AS n_lines,
        length(t) - length(replace(t, '!', '')) AS n_bangs,
        length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) AS n_capitals
      FROM d JOIN w USING (rid) LEFT JOIN repeats USING (rid)),
s AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, greatest(
        n_symbols::DOUBLE / greatest(n_words, 1) / {ref["symbols"]}::DOUBLE,
        n_repeat_words::DOUBLE / greatest(n_words, 1) / {ref["repeats"]}::DOUBLE,
        n_dup_lines::DOUBLE / greatest(n_lines, 1) / {ref["dup_lines"]}::DOUBLE,
        n_capitals::DOUBLE / greatest(word_chars, 1) / {ref["capitals"]}::DOUBLE,
        n_bangs::DOUBLE / greatest(n_words, 1) / {ref["bangs"]}::DOUBLE) AS score FROM m),
c AS (SELECT {rq.CUTOFFS}::DOUBLE[] AS cutoffs),
known AS (SELECT doc_id, max(CASE WHEN quality > 0 THEN 1 ELSE 0 END) AS good FROM labels
          WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
tally AS (SELECT stratum, len(list_filter(cutoffs, lambda x: x >= score)) AS level, good
          FROM s JOIN known USING (doc_id), c),
sizes AS (SELECT * FROM (SELECT stratum, sum(good)::BIGINT AS n, count(*) - sum(good) AS all_poor, count(*) OVER () AS m
          FROM tally GROUP BY stratum) WHERE n > 0),
tails AS (SELECT stratum, n, all_poor, m, k, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)
            + k * ln({rq.ALPHA}) + (n - k) * ln(1 - {rq.ALPHA}))) OVER (PARTITION BY stratum ORDER BY k) AS cdf
          FROM (SELECT *, unnest(generate_series(0, ceil(n * {rq.ALPHA})::BIGINT)) AS k FROM sizes)),
limits AS (SELECT stratum, n, all_poor, coalesce(max(k) FILTER (WHERE cdf <= {rq.DELTA} / m), -1) AS most
           FROM tails GROUP BY ALL),
path AS (SELECT l.stratum, l.level, any_value(most) AS most, any_value(all_poor) AS all_poor,
           coalesce(sum(g.good), 0) AS rejected_good, count(g.good) - coalesce(sum(g.good), 0) AS rejected_poor
         FROM (SELECT *, unnest(range({len(rq.CUTOFFS)})) AS level FROM limits) l
         LEFT JOIN tally g ON g.stratum IS NOT DISTINCT FROM l.stratum AND g.level <= l.level
         GROUP BY l.stratum, l.level),
best AS (SELECT stratum, arg_min(level, ({rq.REJECTION_COST} * rejected_good + all_poor - rejected_poor)
            * 1000 + level) AS level
         FROM path WHERE rejected_good <= most AND rejected_poor > 0 GROUP BY stratum),
chosen AS (SELECT stratum, cutoffs[level + 1] AS cutoff FROM best, c),
verdict AS (SELECT s.*, NOT base_failed AND coalesce(score <= cutoff, true) AS kept
            FROM s LEFT JOIN chosen ON s.stratum IS NOT DISTINCT FROM chosen.stratum)
{out}"""


MIX = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source,
             len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
        row_number() OVER (ORDER BY source NULLS LAST) AS place,
        ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
      FROM d GROUP BY source),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING
          AND 1 PRECEDING), 0))::DOUBLE / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        , row_number() OVER o AS turn
      FROM s WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST)),
f AS (SELECT min(turn) AS first FROM l WHERE 3 * source_size >= level * weight),
t AS (SELECT l.*, CASE WHEN turn < first THEN 3.0 * source_size
        ELSE least(3 * source_size, weight * max(CASE WHEN turn = first THEN level END) OVER ()) END::DOUBLE AS target
      FROM l, f),
q AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM t),
r AS (SELECT *, CASE WHEN source_size > 0 THEN least(round((target - passes * source_size) / {ss.BLOCK_WORDS})::BIGINT,
          ceil(source_size / {ss.BLOCK_WORDS})::BIGINT) * {ss.BLOCK_WORDS} ELSE 0 END AS part FROM q),
laid AS (SELECT d.*, source_size, target, passes, part, place, coalesce(sum(size) OVER (PARTITION BY d.source
           ORDER BY md5('{ss.SEED}:' || doc_id::VARCHAR), doc_id, size, rid
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
         FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
due AS (SELECT place, ceil(source_size / {ss.BLOCK_WORDS})::BIGINT AS blocks,
          (passes * ceil(source_size / {ss.BLOCK_WORDS}) + part // {ss.BLOCK_WORDS})::BIGINT AS due FROM r),
total AS (SELECT coalesce(sum(due), 0)::BIGINT AS n FROM due),
share AS (SELECT place, due, (sum(due) OVER (ORDER BY place) - due) / n::DOUBLE AS low,
            sum(due) OVER (ORDER BY place) / n::DOUBLE AS high FROM due, total WHERE due > 0),
point AS (SELECT i AS slot, list_sum([((i >> b) & 1) / 2.0::DOUBLE ** (b + 1) FOR b IN range(40)]) AS u
          FROM (SELECT unnest(range(n)) AS i FROM total)),
ranked AS (SELECT slot, place, due, row_number() OVER (PARTITION BY place ORDER BY slot) - 1 AS rank
           FROM point JOIN share ON u >= low AND u < high),
lack AS (SELECT place, rank, row_number() OVER (ORDER BY place, rank) AS turn FROM (
           SELECT place, unnest(range(got, due)) AS rank FROM (
             SELECT due.place, due.due, count(slot) AS got FROM due LEFT JOIN ranked USING (place)
             GROUP BY due.place, due.due))),
over_due AS (SELECT slot, row_number() OVER (ORDER BY slot) AS turn FROM ranked WHERE rank >= due),
slots AS (SELECT slot, place, rank FROM ranked WHERE rank < due
          UNION ALL SELECT slot, place, rank FROM lack JOIN over_due USING (turn)),
block AS (SELECT rid, place, unnest(range((start // {ss.BLOCK_WORDS})::BIGINT,
            ((start + size - 1) // {ss.BLOCK_WORDS} + 1)::BIGINT)) AS block
          FROM laid WHERE size > 0),
early AS (SELECT rid, min(slot) AS first_slot FROM block
          JOIN (SELECT slot, place, rank % blocks AS block FROM slots JOIN due USING (place)) USING (place, block) GROUP BY rid)
SELECT doc_id, size, source_size, target,
  (passes * size + greatest(0, least(start + size, part) - start))::BIGINT AS taken, first_slot
FROM laid LEFT JOIN early USING (rid)"""


LINES = f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS no FROM documents),
s AS (SELECT doc_id, no, list_sort(list_distinct(regexp_extract_all(
        translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}'))) AS words FROM l),
k AS (SELECT * FROM s WHERE len(words) >= {ls.MIN_WORDS}),
sets AS (SELECT words, min((doc_id, no)) AS first, row_number() OVER () AS sid FROM k GROUP BY words),
w AS (SELECT sid, len(words) AS n, unnest(words) AS word FROM sets),
f AS (SELECT word, count(*) AS often FROM w GROUP BY word),
p AS (SELECT sid, word, n, row_number() OVER (PARTITION BY sid ORDER BY often, word) AS place FROM w JOIN f USING (word)),
pre AS (SELECT sid, word FROM p WHERE place <= n - (n * {ls.PERCENT} + 99) // 100 + 1),
c AS (SELECT DISTINCT a.sid AS x, b.sid AS y FROM pre a JOIN pre b ON a.word = b.word AND a.sid <> b.sid),
m AS (SELECT DISTINCT x FROM c JOIN sets a ON a.sid = x JOIN sets b ON b.sid = y
      WHERE b.first < a.first AND 100 * len(list_intersect(a.words, b.words))
        >= {ls.PERCENT} * (len(a.words) + len(b.words) - len(list_intersect(a.words, b.words)))),
gone AS (SELECT doc_id, no FROM k JOIN sets USING (words) WHERE (doc_id, no) <> first OR sid IN (SELECT x FROM m)),
kept AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY no) AS text FROM l
         LEFT JOIN gone USING (doc_id, no) WHERE gone.no IS NULL GROUP BY l.doc_id),
t AS (SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
      FROM documents d LEFT JOIN kept USING (doc_id))
SELECT doc_id, len(string_split(text, chr(10)))::INT AS n_lines, length(text)::INT AS n_chars, md5(text) AS text_md5 FROM t"""


def _groups(width: int, percent: int, kept: str = "") -> str:
    """Size and component of the sets of runs of ``width`` words."""
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {width} THEN [array_to_string(words, ' ')]
         ELSE list_transform(range(1, len(words) - {width - 2}), lambda i: array_to_string(words[i:i + {width - 1}], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id
         GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
          WHERE 100 * c >= {percent} * (a.n + b.n - c)),
reach AS (WITH RECURSIVE r AS (
            SELECT doc_id AS node, doc_id AS root FROM w
            UNION SELECT e.y, r.root FROM r JOIN (SELECT x, y FROM links UNION ALL SELECT y, x FROM links) e ON e.x = r.node)
          SELECT node, min(root) AS root FROM r GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, reach.root AS component_id{kept}
FROM w LEFT JOIN n USING (doc_id) JOIN reach ON reach.node = w.doc_id"""


_CONTROL = "|".join([r"\\", *(c.replace("[", r"\[").replace("]", r"\]").replace("|", r"\|") for c in cp.CONTROLS)])
TALKS = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, * FROM (VALUES (0, 'user', '</s>[INST] ok [/INST]'), (1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(20 + length(role) + length(text) + len(regexp_extract_all(role, '{_CONTROL}'))
      + len(regexp_extract_all(text, '{_CONTROL}')))::BIGINT AS formatted_chars,
  0::BIGINT AS expanded_tokens
FROM t GROUP BY conv_id"""


FIM = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
        list_transform([0, 1, 2, 3], lambda i: ('0x' || substr(h, 8 * i + 1, 8))::BIGINT) AS draw FROM d),
c AS (SELECT *, len(units)::BIGINT AS n, least(draw[1] % (len(units) + 1), draw[2] % (len(units) + 1)) AS low,
        greatest(draw[1] % (len(units) + 1), draw[2] % (len(units) + 1)) AS high,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR draw[3] % 100 >= 50 THEN 'plain'
             WHEN draw[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, n, form, t, array_to_string(units[1:low], '') AS a, array_to_string(units[low + 1:high], '') AS b,
        array_to_string(units[high + 1:], '') AS c FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(b) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
         ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""


LLM_SQL = {"op13_fim_chunks": FIM, "op4_jaccard_join": _groups(jj.SHINGLE, jj.PERCENT), "op12_chosen_path": _groups(paths.SHINGLE, paths.PERCENT, ", w.doc_id = reach.root AS kept"), "op5_chat_parts": TALKS, "op10_line_simjoin": LINES, "op7_risk_quality": _quality(), "op9_source_schedule": MIX}
