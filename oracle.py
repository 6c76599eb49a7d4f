"""The registered queries restated in SQL for a single-node engine.

Written from the definitions, not from the Spark plans: candidate pairs come
from brute-force comparisons or plain bucket self-joins over all documents,
and evaluation runs over every document pair, copies included.
"""

from __future__ import annotations

from echofind.functions import hashing, text
from echofind.plans import queries as q

SPACES = r"[\t-\r\x1c-\x20\x{85}\p{Z}]+"
PUNCTUATION = r"[^\p{L}\p{N}_\t-\r\x1c-\x20\x{85}\p{Z}]+"
P = hashing.MINHASH_PRIME


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def strip_tags(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]+>', '', 'g')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACES}', ' ', 'g'), ' ')"


def clean(x: str) -> str:
    return f"lower(regexp_replace({squeeze(strip_tags(x))}, '{PUNCTUATION}', '', 'g'))"


def split(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{SPACES}'), lambda w: w <> '')"


def without(words_sql: str, stopwords) -> str:
    return f"list_filter({words_sql}, lambda w: w NOT IN ({quoted(stopwords)}))"


def pad(x: str) -> str:
    return f"CASE WHEN len({split(x)}) < 3 THEN {x} || '{text.FILLER}' ELSE {x} END"


def bit(value: str, i: int) -> str:
    return f"(({value} >> {i}) & 1)"


def binary(value: str, bits: int) -> str:
    return " || ".join(f"{bit(value, i)}::varchar" for i in reversed(range(bits)))


def minima() -> str:
    params = hashing.minhash_params(q.NUM_HASHES, q.SEED)
    return ", ".join(f"min((h % {P} * {a} + {b}) % {P})" for a, b in params)


def majority(weight: str, bits: int) -> str:
    votes = (f"CASE WHEN sum(CASE WHEN {bit('h', i)} = 1 THEN {weight} ELSE -{weight} END) > 0 THEN {1 << i} ELSE 0 END" for i in range(bits))
    return "(" + " + ".join(votes) + ")::bigint"


def md5_hash(x: str, bits: int = 32) -> str:
    return f"(('0x' || substr(md5({x}), 1, 8))::bigint & {(1 << bits) - 1})"


def sampled(value: str, indices) -> str:
    return "(" + " + ".join(f"({bit(value, index)} << {i})" for i, index in enumerate(indices)) + ")"


def slices(bands: int, rows: int) -> str:
    return ", ".join(f"list_slice(s, {k * rows + 1}, {(k + 1) * rows})" for k in range(bands))


def banded(source: str, id_col: str, bands: int, rows: int) -> str:
    cut = f"[{slices(bands, rows)}]"
    return (
        f"SELECT {id_col}, unnest(range({bands}))::int AS band, unnest({cut}) AS key FROM {source} WHERE s IS NOT NULL"
    )


def shingled(docs: str, id_col: str, n: int) -> str:
    words = " || ' ' || ".join(["word"] + [f"lead(word, {k}) OVER w" for k in range(1, n)])
    return f"""SELECT {id_col}, pos, g FROM (
      SELECT {id_col}, pos, {words} AS g FROM {docs} WINDOW w AS (PARTITION BY {id_col} ORDER BY pos)) WHERE g IS NOT NULL"""


TABLES = hashing.bit_tables(q.HASH_BITS, q.NUM_TABLES, q.BITS_PER_TABLE, q.SEED)
SAMPLE = hashing.sample_bit_indices(q.VECTOR_BITS, q.SAMPLE_SIZE, q.SEED)


def table_equal(x: str, y: str) -> str:
    return "(" + " OR ".join(f"{sampled(x, t)} = {sampled(y, t)}" for t in TABLES) + ")"


def weighted(members: str, pairs: str) -> str:
    """All pairs, counted between the smallest ids of their signatures."""
    return f"""
      SELECT least(a.head, b.head) AS id1, greatest(a.head, b.head) AS id2, count(*) AS n_pairs
      FROM {pairs} p JOIN {members} a ON a.doc_id = p.id1 JOIN {members} b ON b.doc_id = p.id2 GROUP BY ALL"""


def heads(source: str, key: str) -> str:
    return f"SELECT doc_id, min(doc_id) OVER (PARTITION BY {key}) AS head FROM {source}"


CTES: dict[str, str] = {
    "c": f"SELECT doc_id, {clean('text')} AS text FROM documents",
    "w": f"SELECT doc_id, {split('text')} AS words FROM c",
    "tok": "SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w",
    "tf": "SELECT doc_id, word AS token, count(*) AS tf FROM tok GROUP BY ALL",
    "gram": shingled("tok", "doc_id", 3),
    "gset": "SELECT DISTINCT doc_id, g FROM gram",
    "mh": f"SELECT doc_id, [{minima()}] AS s FROM (SELECT doc_id, {md5_hash('g')} AS h FROM gset) GROUP BY doc_id",
    "band": banded("mh", "doc_id", q.NUM_BANDS, q.ROWS_PER_BAND),
    "mp": "SELECT DISTINCT a.doc_id AS id1, b.doc_id AS id2 FROM band a JOIN band b USING (band, key) WHERE a.doc_id < b.doc_id",
    "mhead": heads("mh", "s"),
    "tp": weighted("chead", "mp"),
    "tset": "SELECT DISTINCT doc_id, word AS token FROM tok",
    "sh": f"""SELECT d.doc_id, coalesce(v.s, 0) AS s FROM c d LEFT JOIN (
        SELECT doc_id, {majority('1', q.HASH_BITS)} AS s
        FROM (SELECT doc_id, {md5_hash('token', q.HASH_BITS)} AS h FROM tset) GROUP BY doc_id) v USING (doc_id)""",
    "shg": f"""SELECT d.doc_id, coalesce(v.s, 0) AS s FROM c d LEFT JOIN (
        SELECT doc_id, {majority('1', q.HASH_BITS)} AS s
        FROM (SELECT doc_id, {md5_hash('g', q.HASH_BITS)} AS h FROM gset) GROUP BY doc_id) v USING (doc_id)""",
    "sp": f"SELECT a.doc_id AS id1, b.doc_id AS id2 FROM sh a JOIN sh b ON a.doc_id < b.doc_id AND bit_count(xor(a.s, b.s)) <= {q.RADIUS}",
    "shead": heads("sh", "s"),
    "sgp": f"SELECT a.doc_id AS id1, b.doc_id AS id2 FROM shg a JOIN shg b ON a.doc_id < b.doc_id AND bit_count(xor(a.s, b.s)) <= {q.RADIUS}",
    "pairwise": "SELECT mh.doc_id, mh.s AS m, shg.s AS x FROM mh JOIN shg USING (doc_id)",
    "bhead": heads("pairwise", "(m, x)"),
    "bhead2": "SELECT doc_id, min(doc_id) OVER (PARTITION BY mh.s, shg.s) AS head FROM shg LEFT JOIN mh USING (doc_id)",
    "vec": f"""SELECT d.doc_id, coalesce(v.x, 0)::bigint AS vector FROM c d LEFT JOIN (
        SELECT doc_id, bit_xor({md5_hash('token', q.VECTOR_BITS)}) AS x FROM tset GROUP BY doc_id) v USING (doc_id)""",
    "samp": f"SELECT doc_id, {sampled('vector', SAMPLE)}::bigint AS signature FROM vec",
    # benchmark probes
    "pc": f"SELECT item_id AS probe_id, {clean('text')} AS text FROM benchmark",
    "pw": f"SELECT probe_id, {split('text')} AS words FROM pc",
    "ptok": "SELECT probe_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM pw",
    "pgram": shingled("ptok", "probe_id", 3),
    "pgset": "SELECT DISTINCT probe_id, g FROM pgram",
    "pmh": f"SELECT probe_id, [{minima()}] AS s FROM (SELECT probe_id, {md5_hash('g')} AS h FROM pgset) GROUP BY probe_id",
    "psh": f"""SELECT d.probe_id, coalesce(v.s, 0) AS s FROM pc d LEFT JOIN (
        SELECT probe_id, {majority('1', q.HASH_BITS)} AS s
        FROM (SELECT DISTINCT probe_id, {md5_hash('word', q.HASH_BITS)} AS h, word FROM ptok) GROUP BY probe_id) v USING (probe_id)""",
    "pshg": f"""SELECT d.probe_id, coalesce(v.s, 0) AS s FROM pc d LEFT JOIN (
        SELECT probe_id, {majority('1', q.HASH_BITS)} AS s
        FROM (SELECT probe_id, {md5_hash('g', q.HASH_BITS)} AS h FROM pgset) GROUP BY probe_id) v USING (probe_id)""",
    "pband": banded("pmh", "probe_id", q.PROBE_BANDS, q.PROBE_ROWS),
    "iband": banded("mh", "doc_id", q.PROBE_BANDS, q.PROBE_ROWS),
    "mq": "SELECT DISTINCT probe_id, doc_id FROM pband JOIN iband USING (band, key)",
    # every twentieth document as a probe
    "dmh": "SELECT doc_id AS probe_id, s FROM mh WHERE doc_id % 20 = 0",
    "dshg": "SELECT doc_id AS probe_id, s FROM shg WHERE doc_id % 20 = 0",
    "dsh": "SELECT doc_id AS probe_id, s FROM sh WHERE doc_id % 20 = 0",
    "dband": banded("dmh", "probe_id", q.PROBE_BANDS, q.PROBE_ROWS),
    "dq": "SELECT DISTINCT probe_id, doc_id FROM dband JOIN iband USING (band, key)",
    # corpus weights
    "vt": "SELECT doc_id, word AS token, count(*) AS tf FROM tok WHERE length(word) >= 2 GROUP BY ALL",
    "idf": """SELECT token, ln((1.0::double + (SELECT count(*) FROM documents)) / (1.0::double + count(*))) + 1 AS idf
        FROM vt GROUP BY token""",
    "tfidf": """SELECT token, sum(x / norm) AS weight FROM (
        SELECT doc_id, token, tf * idf AS x, sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS norm
        FROM vt JOIN idf USING (token)) GROUP BY token""",
    # similarity
    "whs": f"""SELECT d.doc_id, coalesce(v.s, 0) AS s FROM c d LEFT JOIN (
        SELECT doc_id, {majority('u', q.HASH_BITS)} AS s FROM (
          SELECT t.doc_id, {md5_hash('t.token', q.HASH_BITS)} AS h, coalesce(round(k.weight * 1000000.0::double)::bigint, 1000000) AS u
          FROM tset t LEFT JOIN tfidf k ON k.token = t.token) GROUP BY doc_id) v USING (doc_id)""",
    "norm": "SELECT doc_id, sum(tf * tf) AS n2 FROM tf GROUP BY doc_id",
    "tsize": "SELECT doc_id, count(*) AS n FROM tf GROUP BY doc_id",
    "gsize": "SELECT doc_id, count(*) AS n FROM gset GROUP BY doc_id",
    "cos": """SELECT p.id1, p.id2, coalesce(d.dot, 0) / (sqrt(a.n2::double) * sqrt(b.n2::double)) AS similarity
        FROM mp p JOIN norm a ON a.doc_id = p.id1 JOIN norm b ON b.doc_id = p.id2
        LEFT JOIN (SELECT id1, id2, sum(x.tf * y.tf)::double AS dot FROM mp
                   JOIN tf x ON x.doc_id = id1 JOIN tf y ON y.doc_id = id2 AND y.token = x.token GROUP BY id1, id2) d
        ON d.id1 = p.id1 AND d.id2 = p.id2""",
    "truth": f"""SELECT id1, id2, k / (a.n + b.n - k)::double AS similarity FROM (
          SELECT x.doc_id AS id1, y.doc_id AS id2, count(*) AS k FROM gset x JOIN gset y ON x.g = y.g AND x.doc_id < y.doc_id
          GROUP BY ALL) JOIN gsize a ON a.doc_id = id1 JOIN gsize b ON b.doc_id = id2
        WHERE k / (a.n + b.n - k)::double >= {q.TRUTH_THRESHOLD}::double""",
    "chead": heads("c", "text"),
}

DEPENDS: dict[str, tuple[str, ...]] = {
    "w": ("c",), "tok": ("w",), "tf": ("tok",), "gram": ("tok",), "gset": ("gram",), "mh": ("gset",),
    "band": ("mh",), "mp": ("band",), "mhead": ("mh",), "tp": ("chead", "mp"), "tset": ("tok",),
    "sh": ("c", "tset"), "shg": ("c", "gset"), "sp": ("sh",), "shead": ("sh",), "sgp": ("shg",), 
    "bhead2": ("mh", "shg"), "pairwise": ("mh", "shg"), "bhead": ("pairwise",), "vec": ("c", "tset"), "samp": ("vec",),
    "pw": ("pc",), "ptok": ("pw",), "pgram": ("ptok",), "pgset": ("pgram",), "pmh": ("pgset",),
    "psh": ("pc", "ptok"), "pshg": ("pc", "pgset"), "pband": ("pmh",), "iband": ("mh",), "mq": ("pband", "iband"),
    "dmh": ("mh",), "dshg": ("shg",), "dsh": ("sh",), "dband": ("dmh",), "dq": ("dband", "iband"), "vt": ("tok",), "idf": ("vt",), "tfidf": ("vt", "idf"), "norm": ("tf",), "whs": ("c", "tset", "tfidf"), "tsize": ("tf",), "gsize": ("gset",),
    "cos": ("mp", "norm", "tf"), "truth": ("gset", "gsize"), "chead": ("c",),
}


def with_ctes(body: str, *names: str) -> str:
    """Prefix ``body`` with the named tables and everything they are built from."""
    wanted: list[str] = []

    def visit(name: str) -> None:
        for parent in DEPENDS.get(name, ()):
            visit(parent)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        visit(name)
    if not wanted:
        return body
    tables = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in wanted)
    return f"WITH {tables}\n{body}"


def _weights_simhash(weights: str, column: str, bits: int, output: str) -> str:
    units = f"coalesce(round(k.{column} * 1000000.0::double)::bigint, 1000000)"
    return f"""SELECT d.doc_id, {output.format(v='coalesce(v.s, 0)')} FROM c d LEFT JOIN (
        SELECT doc_id, {majority('u', bits)} AS s FROM (
          SELECT t.doc_id, {md5_hash('t.token', bits)} AS h, {units} AS u
          FROM tset t LEFT JOIN {weights} k ON k.token = t.token) GROUP BY doc_id) v USING (doc_id)"""


def _kept(strategy: str) -> tuple[str, list[str]]:
    """The hybrid pairs of a strategy and the tables they are selected from."""
    distance = "bit_count(xor(a.x, b.x))"
    joined = "JOIN pairwise a ON a.doc_id = p.id1 JOIN pairwise b ON b.doc_id = p.id2"
    if strategy == "union":
        return "SELECT id1, id2 FROM mp UNION SELECT id1, id2 FROM sgp", ["mp", "sgp"]
    if strategy == "intersection":
        return "SELECT id1, id2 FROM mp INTERSECT SELECT id1, id2 FROM sgp", ["mp", "sgp"]
    if strategy == "two-stage":
        return f"SELECT p.id1, p.id2 FROM mp p {joined} WHERE {distance} <= {q.RADIUS}", ["mp", "pairwise"]
    m = f"(len(list_filter(list_zip(a.m, b.m), lambda z: z[1] = z[2])) / {q.NUM_HASHES}::double)"
    s = f"(1.0::double - {distance} / {float(q.HASH_BITS)}::double)"
    score = f"{q.WEIGHTED_MINHASH}::double * {m} + {q.WEIGHTED_SIMHASH}::double * {s}"
    kept = f"""SELECT p.id1, p.id2 FROM (SELECT id1, id2 FROM mp UNION SELECT id1, id2 FROM sgp) p {joined}
        WHERE {m} >= {q.MINHASH_SCORE}::double AND {score} >= {q.WEIGHTED_SCORE}::double"""
    return kept, ["mp", "sgp", "pairwise"]


def _hybrid(strategy: str) -> str:
    heads_of = "bhead2" if strategy == "union" else "bhead"
    kept, names = _kept(strategy)
    return with_ctes(weighted(heads_of, f"({kept})"), heads_of, *names)


def _probed(strategy: str) -> str:
    near = f"SELECT probe_id, doc_id FROM dshg a JOIN shg b ON bit_count(xor(a.s, b.s)) <= {q.PROBE_RADIUS}"
    found = {"union": f"SELECT probe_id, doc_id FROM dq UNION {near}", "intersection": f"SELECT probe_id, doc_id FROM dq INTERSECT {near}"}
    judged = "JOIN dmh USING (probe_id) JOIN dshg USING (probe_id) JOIN mh USING (doc_id) JOIN shg USING (doc_id)"
    distance = "bit_count(xor(dshg.s, shg.s))"
    m = f"(len(list_filter(list_zip(dmh.s, mh.s), lambda z: z[1] = z[2])) / {q.NUM_HASHES}::double)"
    score = f"{q.PROBE_WEIGHTS}::double * {m} + {1 - q.PROBE_WEIGHTS}::double * (1.0::double - {distance} / {float(q.HASH_BITS)}::double)"
    found["two-stage"] = f"SELECT probe_id, doc_id FROM dq {judged} WHERE {distance} <= {q.PROBE_RADIUS}"
    found["weighted"] = f"""SELECT probe_id, doc_id FROM ({found['union']}) {judged}
        WHERE {m} >= {q.PROBE_MINHASH}::double AND {score} >= {q.PROBE_SCORE}::double"""
    return with_ctes(found[strategy], "dq", "dmh", "dshg", "mh", "shg")


def _end_to_end(pairs: str, *names: str) -> str:
    """Cosine of all document pairs, averaged between distinct texts."""
    return with_ctes(
        f"""SELECT lo AS id1, hi AS id2, count(*) AS n_pairs, round(avg(similarity), 6) AS similarity FROM (
            SELECT least(x.head, y.head) AS lo, greatest(x.head, y.head) AS hi,
              coalesce(d.dot, 0) / (sqrt(a.n2::double) * sqrt(b.n2::double)) AS similarity
            FROM ({pairs}) p JOIN chead x ON x.doc_id = p.id1 JOIN chead y ON y.doc_id = p.id2
            JOIN norm a ON a.doc_id = p.id1 JOIN norm b ON b.doc_id = p.id2
            LEFT JOIN (SELECT id1, id2, sum(u.tf * v.tf)::double AS dot FROM ({pairs})
                       JOIN tf u ON u.doc_id = id1 JOIN tf v ON v.doc_id = id2 AND v.token = u.token GROUP BY id1, id2) d
            ON d.id1 = p.id1 AND d.id2 = p.id2) GROUP BY ALL""",
        "chead", "norm", "tf", *names,
    )


def _histogram(scored: str) -> str:
    return f"""
      SELECT 'similarity' AS kind, least(floor(round(similarity * 10, 6)), 9)::bigint AS bin, count(*) AS n
      FROM {scored} GROUP BY ALL
      UNION ALL
      SELECT 'pairs_per_document', bin, count(*) FROM (
        SELECT id, count(*) AS bin FROM (SELECT id1 AS id FROM {scored} UNION ALL SELECT id2 FROM {scored}) GROUP BY id)
      GROUP BY bin"""


def _config_clean(stopwords) -> str:
    return f"array_to_string({without(split(clean('text')), stopwords)}, ' ')"


def oracle_sql() -> dict[str, str]:
    extra = text.stopword_list(None, q.EXTRA_STOPWORDS)
    stop = q.STOPWORDS
    bitsampled = f"""SELECT a.doc_id AS id1, b.doc_id AS id2 FROM sh a JOIN sh b ON a.doc_id < b.doc_id
        AND bit_count(xor(a.s, b.s)) <= {q.TABLE_RADIUS} AND {table_equal('a.s', 'b.s')}"""
    near = f"""SELECT probe_id, doc_id FROM psh a JOIN sh b ON bit_count(xor(a.s, b.s)) <= {q.PROBE_RADIUS}"""
    matched_grams = "SELECT count(*) FROM gset x JOIN gset y USING (g) WHERE x.doc_id = l.id1 AND y.doc_id = l.id2"
    linked_dot = """(SELECT id1, id2, sum(x.tf * y.tf)::double AS dot, count(*) AS shared FROM tp
        JOIN tf x ON x.doc_id = id1 JOIN tf y ON y.doc_id = id2 AND y.token = x.token GROUP BY id1, id2)"""

    def linked(value: str, *names: str) -> str:
        return with_ctes(
            f"""SELECT l.id1, l.id2, l.n_pairs, round({value}, 6) AS similarity FROM tp l
            LEFT JOIN {linked_dot} d ON d.id1 = l.id1 AND d.id2 = l.id2
            JOIN norm a ON a.doc_id = l.id1 JOIN norm b ON b.doc_id = l.id2
            JOIN tsize ta ON ta.doc_id = l.id1 JOIN tsize tb ON tb.doc_id = l.id2""",
            "tp", "tf", "norm", "tsize", *names,
        )

    cosine_of_candidates = with_ctes(
            """SELECT a.head AS id1, b.head AS id2, count(*) AS n_pairs, round(avg(similarity), 6) AS similarity
            FROM (SELECT least(x.head, y.head) AS lo, greatest(x.head, y.head) AS hi, similarity FROM cos
                  JOIN chead x ON x.doc_id = id1 JOIN chead y ON y.doc_id = id2) p
            JOIN (SELECT DISTINCT head FROM chead) a ON a.head = p.lo JOIN (SELECT DISTINCT head FROM chead) b ON b.head = p.hi
            GROUP BY ALL""", "cos", "chead"
        )
    # One row of the common-subsequence table for each word of the earlier turn.
    cell = "lambda j: CASE WHEN j = 0 THEN 0 ELSE greatest(r[j + 1], r[j] + (CASE WHEN b[j] = a[i + 1] THEN 1 ELSE 0 END)) END"
    turn_diff = f"""WITH RECURSIVE t AS (
        SELECT conv_id * 1000 + turn AS id1, conv_id * 1000 + lead(turn) OVER w AS id2, {split('text')} AS a, lead({split('text')}) OVER w AS b
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
      d AS (SELECT id1, id2, a, b, 0 AS i, list_transform(range(len(b) + 1), lambda j: 0::bigint) AS r FROM t WHERE id2 IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL
        UNION ALL SELECT id1, id2, a, b, i + 1, list_transform(range(len(b) + 1), lambda k: list_max(c[1 : k + 1]))
        FROM (SELECT *, list_transform(range(len(b) + 1), {cell}) AS c FROM d WHERE i < len(a)))
      SELECT id1, id2, r[len(b) + 1]::int AS kept, (len(a) - r[len(b) + 1])::int AS deleted, (len(b) - r[len(b) + 1])::int AS added
      FROM d WHERE i = len(a)"""

    return {
        "clean_text": f"SELECT doc_id, {clean('text')} AS cleaned FROM documents",
        "clean_text_config": f"SELECT doc_id, {pad('x')} AS cleaned FROM (SELECT doc_id, {_config_clean(extra)} AS x FROM documents)",
        "strip_html": f"SELECT page_id, {strip_tags('html')} AS stripped FROM pages",
        "normalize_whitespace": f"SELECT doc_id, {squeeze('text')} AS normalized FROM documents",
        "remove_stopwords": with_ctes(
            f"SELECT doc_id, array_to_string({without('words', stop)}, ' ') AS kept FROM w", "w"
        ),
        "pad_short_text": f"""SELECT conv_id, turn, {pad('x')} AS padded
            FROM (SELECT conv_id, turn, {clean('text')} AS x FROM conversations)""",
        "tokenize": with_ctes(
            f"""SELECT doc_id, len(t)::int AS n, array_to_string(t, ' ') AS tokens
            FROM (SELECT doc_id, {without('words', stop)} AS t FROM w)""", "w"
        ),
        "ngrams": with_ctes(
            f"""SELECT c.doc_id, count(g)::int AS n, coalesce(string_agg(g, '|' ORDER BY pos), '') AS ngrams
            FROM c LEFT JOIN ({shingled('tok', 'doc_id', 2)}) USING (doc_id) GROUP BY c.doc_id""", "c", "tok"
        ),
        "preprocess_dataset": f"""WITH x AS (SELECT doc_id, {_config_clean(stop)} AS t FROM documents),
            y AS (SELECT doc_id, {pad('t')} AS cleaned_text FROM x),
            z AS (SELECT *, {without(split('cleaned_text'), stop)} AS t FROM y),
            u AS (SELECT doc_id, unnest(t) AS word, generate_subscripts(t, 1) AS pos FROM z),
            v AS ({shingled('u', 'doc_id', 2)})
            SELECT z.doc_id, z.cleaned_text, array_to_string(z.t, ' ') AS tokens, coalesce(k.ngrams, '') AS ngrams
            FROM z LEFT JOIN (SELECT doc_id, string_agg(g, '|' ORDER BY pos) AS ngrams FROM v GROUP BY doc_id) k USING (doc_id)""",
        "ngram_set": with_ctes(
            "SELECT c.doc_id, count(g)::int AS n, coalesce(string_agg(g, '|' ORDER BY g), '') AS features FROM c LEFT JOIN gset USING (doc_id) GROUP BY c.doc_id",
            "c", "gset",
        ),
        "token_set": with_ctes(
            "SELECT c.doc_id, count(token)::int AS n, coalesce(string_agg(token, '|' ORDER BY token), '') AS features FROM c LEFT JOIN tset USING (doc_id) GROUP BY c.doc_id",
            "c", "tset",
        ),
        "token_frequency": with_ctes("SELECT doc_id, token, tf FROM tf", "tf"),
        "tfidf_token_weights": with_ctes("SELECT token, round(weight, 4) AS weight FROM tfidf", "tfidf"),
        "idf_token_weights": with_ctes("SELECT token, round(idf, 6) AS weight FROM idf", "idf"),
        "extract_features": with_ctes(
            """SELECT 'ngram' AS method, c.doc_id, count(g)::int AS n FROM c LEFT JOIN gset USING (doc_id) GROUP BY ALL
            UNION ALL SELECT 'token', c.doc_id, count(token)::int FROM c LEFT JOIN tset USING (doc_id) GROUP BY ALL
            UNION ALL SELECT 'frequency', c.doc_id, count(token)::int FROM c LEFT JOIN tf USING (doc_id) GROUP BY ALL""",
            "c", "gset", "tset", "tf",
        ),
        "minhash_signature": with_ctes(
            "SELECT c.doc_id, coalesce(array_to_string(s, ','), '') AS signature FROM c LEFT JOIN mh USING (doc_id)", "c", "mh"
        ),
        "minhash_similarity": with_ctes(
            f"""SELECT id1, id2, n_pairs, len(list_filter(list_zip(a.s, b.s), lambda z: z[1] = z[2])) / {q.NUM_HASHES}::double AS similarity
            FROM tp JOIN mh a ON a.doc_id = id1 JOIN mh b ON b.doc_id = id2""", "tp", "mh"
        ),
        "simhash_signature": with_ctes(f"SELECT doc_id, {binary('s', q.HASH_BITS)} AS signature FROM sh", "sh"),
        "simhash_frequency": with_ctes(
            f"""SELECT d.doc_id, {binary('coalesce(v.s, 0)', q.HASH_BITS)} AS signature FROM c d LEFT JOIN (
            SELECT doc_id, {majority('tf', q.HASH_BITS)} AS s FROM (SELECT doc_id, tf, {md5_hash('token', q.HASH_BITS)} AS h FROM tf)
            GROUP BY doc_id) v USING (doc_id)""", "c", "tf"
        ),
        "simhash_weighted": with_ctes(
            _weights_simhash("tfidf", "weight", q.HASH_BITS, binary("{v}", q.HASH_BITS) + " AS signature"), "c", "tset", "tfidf"
        ),
        "hamming_distance": with_ctes(
            "SELECT id1, id2, n_pairs, bit_count(xor(a.s, b.s))::bigint AS distance FROM tp JOIN shg a ON a.doc_id = id1 JOIN shg b ON b.doc_id = id2",
            "tp", "shg",
        ),
        "bit_vector_xor": with_ctes("SELECT doc_id, vector FROM vec", "vec"),
        "bit_vector_weighted": with_ctes(
            _weights_simhash("idf", "idf", q.VECTOR_BITS, "{v} AS vector"), "c", "tset", "idf"
        ),
        "bit_sample_signature": with_ctes("SELECT doc_id, signature FROM samp", "samp"),
        "bit_sample_similarity": with_ctes(
            f"""SELECT id1, id2, n_pairs, 1.0::double - bit_count(xor(a.signature, b.signature)) / {float(q.SAMPLE_SIZE)}::double AS similarity
            FROM tp JOIN samp a ON a.doc_id = id1 JOIN samp b ON b.doc_id = id2""", "tp", "samp"
        ),
        "hybrid_signature": with_ctes(
            "SELECT c.doc_id, coalesce(array_to_string(mh.s, ','), '') AS minhash, shg.s AS simhash FROM c LEFT JOIN mh USING (doc_id) JOIN shg USING (doc_id)",
            "c", "mh", "shg",
        ),
        "minhash_bands": with_ctes("SELECT doc_id, band, array_to_string(key, ',') AS key FROM band", "band"),
        "minhash_candidate_pairs": with_ctes(weighted("mhead", "mp"), "mhead", "mp"),
        "minhash_query": with_ctes("SELECT probe_id, doc_id FROM mq", "mq"),
        "simhash_buckets": with_ctes(
            f"SELECT doc_id, unnest([s, {', '.join(f'xor(s, {1 << i})' for i in range(q.HASH_BITS))}])::bigint AS bucket FROM sh", "sh"
        ),
        "simhash_candidate_pairs": with_ctes(weighted("shead", "sp"), "shead", "sp"),
        "simhash_query": with_ctes(near, "psh", "sh"),
        "bitsampling_buckets": with_ctes(
            f"""SELECT doc_id, unnest(range({q.NUM_TABLES}))::int AS tbl, unnest([{', '.join(sampled('s', t) for t in TABLES)}])::bigint AS key
            FROM sh""", "sh"
        ),
        "bitsampling_candidate_pairs": with_ctes(weighted("shead", f"({bitsampled})"), "shead", "sh"),
        "bitsampling_query": with_ctes(near + f" AND {table_equal('a.s', 'b.s')}", "psh", "sh"),
        "hybrid_union": _hybrid("union"),
        "hybrid_intersection": _hybrid("intersection"),
        "hybrid_two_stage": _hybrid("two-stage"),
        "hybrid_weighted": _hybrid("weighted"),
        "bitsampling_query_documents": with_ctes(
            f"SELECT probe_id, doc_id FROM dsh a JOIN sh b ON bit_count(xor(a.s, b.s)) <= {q.TABLE_RADIUS} AND {table_equal('a.s', 'b.s')}", "dsh", "sh"
        ),
        "hybrid_query": _probed("union"),
        "hybrid_query_intersection": _probed("intersection"),
        "hybrid_query_two_stage": _probed("two-stage"),
        "hybrid_query_weighted": _probed("weighted"),
        "stored_index_query": _probed("weighted"),
        "cosine_similarity": linked("coalesce(d.dot, 0) / (sqrt(a.n2::double) * sqrt(b.n2::double))"),
        "euclidean_similarity": linked("1 / (1 + sqrt((a.n2 + b.n2)::double - 2 * coalesce(d.dot, 0)))"),
        "jaccard_text": linked("coalesce(d.shared, 0) / (ta.n + tb.n - coalesce(d.shared, 0))::double"),
        "jaccard_sets": with_ctes(
            f"""SELECT id1, id2, n_pairs, round(k / (a.n + b.n - k)::double, 6) AS similarity
            FROM (SELECT l.id1, l.id2, l.n_pairs, ({matched_grams}) AS k FROM tp l)
            JOIN gsize a ON a.doc_id = id1 JOIN gsize b ON b.doc_id = id2""", "tp", "gset", "gsize"
        ),
        "near_duplicate_rate": with_ctes(
            "SELECT count(*) AS candidate_pairs, round(coalesce(avg(similarity), 0), 6) AS near_duplicate_rate FROM cos", "cos"
        ),
        "evaluation_report": with_ctes(
            """SELECT 'result' AS section, 'candidate_pairs' AS name, count(*)::double AS value FROM cos
            UNION ALL SELECT 'result', 'near_duplicate_rate', round(coalesce(avg(similarity), 0), 6) FROM cos""", "cos"
        ),
        "exact_similar_pairs": with_ctes(
            """SELECT id1, id2, round(similarity, 6) AS similarity FROM truth JOIN chead a ON a.doc_id = id1 JOIN chead b ON b.doc_id = id2
            WHERE a.head = id1 AND b.head = id2""", "truth", "chead"
        ),
        "precision_recall_f1": with_ctes(
            """SELECT tp AS true_positives, fp AS false_positives, fn AS false_negatives,
              round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp)::double END, 6) AS precision,
              round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn)::double END, 6) AS recall,
              round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn)::double END, 6) AS f1
            FROM (SELECT count(*) FILTER (t.id1 IS NOT NULL AND m.id1 IS NOT NULL) AS tp,
                         count(*) FILTER (t.id1 IS NULL) AS fp, count(*) FILTER (m.id1 IS NULL) AS fn
                  FROM mp m FULL JOIN truth t ON t.id1 = m.id1 AND t.id2 = m.id2)""", "mp", "truth"
        ),
        "duplicate_distribution": with_ctes(_histogram("cos"), "cos"),
        "sample_pairs": with_ctes(
            f"SELECT id1, id2 FROM mp ORDER BY md5('{q.SEED}:' || id1 || ':' || id2), id1, id2 LIMIT {q.SAMPLE_PAIRS}", "mp"
        ),
        "pair_texts": with_ctes(
            "SELECT id1, id2, a.text AS text1, b.text AS text2 FROM tp JOIN documents a ON a.doc_id = id1 JOIN documents b ON b.doc_id = id2 WHERE id1 < id2", "tp"
        ),
        "read_corpus": "SELECT doc_id, text FROM documents",
        "write_preprocessed": with_ctes("SELECT doc_id, text FROM c", "c"),
        "write_signatures": with_ctes(
            "SELECT c.doc_id, coalesce(array_to_string(s, ','), '') AS signature FROM c LEFT JOIN mh USING (doc_id)", "c", "mh"
        ),
        "write_signatures_csv": with_ctes(f"SELECT doc_id, {binary('s', q.HASH_BITS)} AS text FROM sh", "sh"),
        "write_signatures_wide": with_ctes(
            "SELECT c.doc_id, coalesce(array_to_string(s, ','), '') AS signature FROM c LEFT JOIN mh USING (doc_id)", "c", "mh"
        ),
        "read_corpus_directory": "SELECT doc_id, text FROM documents",
        "find_near_duplicates_vectorize": _end_to_end(
            f"SELECT a.doc_id AS id1, b.doc_id AS id2 FROM whs a JOIN whs b ON a.doc_id < b.doc_id AND bit_count(xor(a.s, b.s)) <= {q.RADIUS}", "whs"
        ),
        "find_near_duplicates_bitsampling": _end_to_end(bitsampled, "sh"),
        "find_near_duplicates_cleaning": cosine_of_candidates.replace(
            CTES["c"],
            f"SELECT doc_id, {pad('x')} AS text FROM (SELECT doc_id, array_to_string({without(split('y'), stop)}, ' ') AS x FROM (SELECT doc_id, {squeeze(strip_tags('text'))} AS y FROM documents))",
        ),
        "find_near_duplicates_hybrid_own": _end_to_end(_kept("weighted")[0], *_kept("weighted")[1])
        .replace(CTES["band"], banded("mh", "doc_id", q.OWN_BANDS, q.OWN_ROWS))
        .replace(CTES["sgp"], CTES["sgp"].replace(f"<= {q.RADIUS}", f"<= {q.OWN_RADIUS}")),
        "pair_diff": turn_diff,
        "find_near_duplicates_hybrid": _end_to_end(_kept("weighted")[0], *_kept("weighted")[1]),
        "read_pairs": with_ctes("SELECT id1, id2 FROM tp WHERE id1 < id2", "tp"),
        "find_near_duplicates": cosine_of_candidates,
    }
