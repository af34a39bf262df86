"""DuckDB SQL for the operators' results on the given tables."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Levels of a tree that the SQL unrolls: enough for 16 ** 6 leaves.
LEVELS = 6
#: Rounds of link propagation that the SQL unrolls.
ROUNDS = 12


def lowered(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{UPPER.lower()}')"


#: One row with the 256 remainders of the CRC-32 polynomial.
CRC_TABLE = """crc_table AS MATERIALIZED (
  SELECT list(v ORDER BY b) AS crc_of FROM (
    SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: xor(c >> 1, 3988292384 * (c & 1))) AS v FROM range(256) r(b)))"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's bytes, in a query over ``crc_table``."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT"
    data = f"list_prepend(4294967295, list_transform(range(strlen({text})), lambda i: {byte}))"
    return f"xor(list_reduce({data}, lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])), 4294967295)"


def _levels(name: str, start: str, walk: str, place: str) -> list[str]:
    """CTEs that fold the nodes of ``start`` (tree, idx, digest) to one a tree, and the rows of ``walk`` along with their place in it."""
    out = [f"{name}0 AS MATERIALIZED ({start})", f"{name}_walk0 AS MATERIALIZED ({walk})"]
    for k in range(LEVELS):
        nodes = f"(SELECT *, count(*) OVER (PARTITION BY tree) AS total FROM {name}{k})"
        out.append(
            f"""{name}_run{k} AS MATERIALIZED (
  SELECT tree, idx // 16 AS run, list(digest ORDER BY idx) AS ds, max(total) AS total FROM {nodes} GROUP BY ALL)"""
        )
        out.append(
            f"""{name}{k + 1} AS MATERIALIZED (
  SELECT tree, run AS idx, CASE WHEN total = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS digest FROM {name}_run{k})"""
        )
        digit = f"(({place} >> {4 * k}) & 15)"
        out.append(
            f"""{name}_walk{k + 1} AS MATERIALIZED (
  SELECT * EXCLUDE (lft, rgt, total) REPLACE (
    CASE WHEN total = 1 THEN folded ELSE sha256(lft || folded || rgt) END AS folded,
    CASE WHEN total = 1 THEN proof ELSE proof || lft || rgt END AS proof)
  FROM (SELECT w.*, r.total, coalesce(array_to_string(ds[1:{digit}], ''), '') AS lft, coalesce(array_to_string(ds[{digit} + 2:], ''), '') AS rgt
        FROM {name}_walk{k} w JOIN {name}_run{k} r ON r.tree = w.{name}_tree AND r.run = ({place} >> {4 * (k + 1)})))"""
        )
    return out


def merkle() -> str:
    field = lambda x: f"coalesce(strlen({x}) || ':' || {x}, '-')"
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", "text"]
    leaf = lambda text: f"sha256({' || '.join(field(text if f == 'text' else f) for f in fields)})"
    chosen = f"{crc32('doc_id::VARCHAR')} % 5 = 0"
    ctes = [
        CRC_TABLE,
        f"""hashed AS MATERIALIZED (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS sub_tree, source, {leaf('text')} AS leaf,
    CASE WHEN {chosen} THEN {leaf(lowered('text'))} END AS altered FROM documents, crc_table)""",
        """ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY sub_tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM hashed)""",
        *_levels(
            "sub",
            "SELECT sub_tree AS tree, place AS idx, leaf AS digest FROM ranked",
            "SELECT *, coalesce(altered, leaf) AS folded, '' AS proof FROM ranked",
            "place",
        ),
        *_levels(
            "top",
            f"SELECT 0 AS tree, tree AS idx, digest FROM sub{LEVELS}",
            f"SELECT *, 0 AS top_tree FROM sub_walk{LEVELS}",
            "sub_tree",
        ),
    ]
    return f"""WITH {', '.join(ctes)}
SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.digest AS verified
FROM top_walk{LEVELS} w JOIN sub{LEVELS} s ON s.tree = w.sub_tree CROSS JOIN top{LEVELS} t"""


def importance() -> str:
    def features(table: str) -> str:
        words = f"regexp_extract_all({lowered("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
        return f"""SELECT *, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f
    FROM (SELECT row_number() OVER () AS row_no, *, {words} AS w FROM {table})"""

    gain = "1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * s_all / ((coalesce(s.n, 0) + 1)::DOUBLE * t_all))"
    noise = "floor(-1000 * ln(-ln((('0x' || left(sha256('7:' || coalesce(doc_id::VARCHAR, '-')), 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))"
    return f"""WITH {CRC_TABLE},
docs AS MATERIALIZED ({features('documents')}),
target AS MATERIALIZED ({features('benchmark')}),
used AS MATERIALIZED (SELECT row_no, unnest(f) AS x FROM docs),
wanted AS MATERIALIZED (SELECT unnest(f) AS x FROM target),
known AS (SELECT x FROM used UNION SELECT x FROM wanted),
bucket_of AS MATERIALIZED (SELECT x, {crc32('x')} % 10000 AS bucket FROM known, crc_table),
s AS (SELECT bucket, count(*) AS n FROM used JOIN bucket_of USING (x) GROUP BY 1),
t AS (SELECT bucket, count(*) AS n FROM wanted JOIN bucket_of USING (x) GROUP BY 1),
sums AS (SELECT (SELECT count(*) + 10000 FROM used)::DOUBLE AS s_all, (SELECT count(*) + 10000 FROM wanted)::DOUBLE AS t_all),
gains AS MATERIALIZED (
  SELECT b AS bucket, floor({gain})::BIGINT AS g FROM range(10000) r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b CROSS JOIN sums),
totals AS (SELECT row_no, sum(g)::BIGINT AS g, count(*) AS n FROM used JOIN bucket_of USING (x) JOIN gains USING (bucket) GROUP BY 1),
weighed AS (
  SELECT docs.row_no, doc_id, len(w) AS words, coalesce(n, 0) AS n_features, coalesce((g - ((g % n) + n) % n) // n, 0) AS weight
  FROM docs LEFT JOIN totals USING (row_no)),
scored AS (SELECT *, weight + {noise}::BIGINT AS score FROM weighed),
placed AS (SELECT row_no, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, weight, n_features) AS place FROM scored WHERE words >= 20),
drawn AS (SELECT * FROM placed WHERE place <= (SELECT 25 * count(*) // 100 FROM placed))
SELECT doc_id, n_features, weight, score, place AS rank FROM scored LEFT JOIN drawn USING (row_no)"""


def url_filter() -> str:
    fits = lambda domain, path: f"((host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{path}'))"
    # Longest first.
    rules = [("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("net", "/", "block")]
    pick = lambda value: "CASE " + " ".join(f"WHEN {fits(d, p)} THEN '{value(d, p, v)}'" for d, p, v in rules) + " END"
    link = "(?i)\\bhref\\s*=\\s*[\"'']?\\s*(?:https?:)?//([^/?#\"''\\s<>]+)"
    rest = "CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END"
    rounds = []
    for k in range(ROUNDS):
        rounds.append(
            f"""mass{k + 1} AS MATERIALIZED (
  SELECT m.kind, m.host, seed, fan, CASE WHEN total = 0 THEN 0 ELSE seed * (0.15 + 0.85 * idle / total) END + 0.85 * coalesce(met, 0) AS mass
  FROM mass{k} m JOIN (SELECT kind, sum(seed) AS total, coalesce(sum(mass) FILTER (fan IS NULL), 0) AS idle FROM mass{k} GROUP BY 1) a ON a.kind = m.kind
  LEFT JOIN (SELECT d.kind, d.dst AS host, sum(mass / fan) AS met FROM directed d JOIN mass{k} m ON m.kind = d.kind AND m.host = d.src GROUP BY 1, 2) f
    ON f.kind = m.kind AND f.host = m.host)"""
        )
    return f"""WITH split AS (SELECT *, coalesce({rest}, '') AS rest FROM pages),
placed AS MATERIALIZED (
  SELECT page_id, html, {lowered("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
judged AS MATERIALIZED (SELECT page_id, host, path, {pick(lambda d, p, v: d + p)} AS rule, {pick(lambda d, p, v: v)} AS ruled FROM placed),
hosts AS MATERIALIZED (
  SELECT host, count(*) AS pages, count(*) FILTER (ruled = 'allow') AS allowed, count(*) FILTER (ruled = 'block') AS blocked
  FROM judged WHERE host <> '' GROUP BY 1),
found AS (SELECT DISTINCT host AS a, {lowered(f"unnest(regexp_extract_all(html, '{link}', 1))")} AS b FROM placed WHERE host <> ''),
directed AS MATERIALIZED (
  SELECT 'trust' AS kind, a AS src, b AS dst FROM found WHERE a <> b UNION ALL SELECT 'distrust', b, a FROM found WHERE a <> b),
sown AS (
  SELECT 'trust' AS kind, host, allowed::DOUBLE AS seed FROM hosts UNION ALL SELECT 'distrust', host, blocked::DOUBLE FROM hosts
  UNION ALL SELECT kind, src, 0 FROM directed UNION ALL SELECT kind, dst, 0 FROM directed),
mass0 AS MATERIALIZED (
  SELECT s.kind, s.host, seed, fan, seed AS mass FROM (SELECT kind, host, sum(seed) AS seed FROM sown GROUP BY 1, 2) s
  LEFT JOIN (SELECT kind, src AS host, count(*) AS fan FROM directed GROUP BY 1, 2) f ON f.kind = s.kind AND f.host = s.host),
{', '.join(rounds)},
spread AS (
  SELECT h.host, round((coalesce(sum(mass) FILTER (kind = 'distrust'), 0) - coalesce(sum(mass) FILTER (kind = 'trust'), 0)) / any_value(pages), 9) AS excess
  FROM hosts h LEFT JOIN mass{ROUNDS} m ON m.host = h.host GROUP BY 1)
SELECT page_id, j.host, path, rule, coalesce(ruled, CASE WHEN excess > 0.25 THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN spread s ON s.host = j.host"""


def warc() -> str:
    uri = "coalesce(nullif(url, ''), 'urn:x-no-uri')"
    return f"""WITH sized AS (
  SELECT page_id, replace(replace({uri}, chr(13), ''), chr(10), '') AS uri, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
placed AS (
  SELECT *, n >= 100 AND row_number() OVER (PARTITION BY digest ORDER BY page_id) > 1 AS again, min(page_id) OVER (PARTITION BY digest) AS first FROM sized)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first END AS refers_to, uri FROM placed"""


def suffix_dedup(length: int = 50) -> str:
    """All windows of all texts: their bytes as hexadecimal pairs, marked where a smaller id has the same window."""
    return f"""WITH coded AS (SELECT row_number() OVER () AS row_no, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT row_no, doc_id, p, substr(h, 2 * p + 1, 2) AS pair, CASE WHEN 2 * (p + {length}) <= length(h) THEN substr(h, 2 * p + 1, {2 * length}) END AS w
  FROM (SELECT *, unnest(range(length(h) // 2)) AS p FROM coded)),
marked AS (SELECT *, w IS NOT NULL AND min(doc_id) OVER (PARTITION BY w) < doc_id AS hit FROM windows),
covered AS (SELECT *, bool_or(hit) OVER (PARTITION BY row_no ORDER BY p ROWS BETWEEN {length - 1} PRECEDING AND CURRENT ROW) AS gone FROM marked),
edged AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY row_no ORDER BY p), false) AS opens FROM covered),
told AS (
  SELECT row_no, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans, string_agg(pair, '' ORDER BY p) FILTER (NOT gone) AS kept
  FROM edged GROUP BY 1)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM coded LEFT JOIN told USING (row_no)"""


CHECKS: dict[str, str] = {
    "op1_warc_writer": warc(),
    "op5_suffix_dedup": suffix_dedup(),
    "op11_merkle_manifest": merkle(),
    "op12_importance_resampling": importance(),
    "op13_url_filter": url_filter(),
}
