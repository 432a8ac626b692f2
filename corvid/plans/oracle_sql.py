"""Oracle SQL (DuckDB dialect) for the registered queries.

Each string runs on the driver tables registered as views and must give the
same rows, column names and types as the matching Spark query. Shared
sub-queries are built once here as CTE text.
"""

from __future__ import annotations

# --- words -----------------------------------------------------------------

LINES_CTE = r"""
lines AS (
  SELECT doc_id,
         CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS line_no,
         unnest(ls) AS line
  FROM (
    SELECT doc_id,
           CASE WHEN text = '' THEN []::VARCHAR[]
                ELSE string_split_regex(regexp_replace(text, '(\r\n|\n|\r)\z', ''), '\r\n|\n|\r')
           END AS ls
    FROM documents
  )
)"""

TOKEN_LISTS_CTE = r"""
token_lists AS (
  SELECT doc_id, line_no,
         CASE WHEN line = '' THEN ['']
              WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[]
              ELSE string_split(rtrim(line, ' '), ' ')
         END AS ts
  FROM lines
),
words AS (
  SELECT doc_id, line_no, unnest(ts) AS word FROM token_lists
)"""

WORDS_PREFIX = f"WITH {LINES_CTE},{TOKEN_LISTS_CTE}\n"


def words_sql() -> dict[str, str]:
    word_count = WORDS_PREFIX + "SELECT word, CAST(count(*) AS BIGINT) AS cnt FROM words GROUP BY word"
    return {
        "doc_lines": f"WITH {LINES_CTE}\nSELECT doc_id, line_no, line FROM lines",
        "row_count": f"WITH {LINES_CTE}\nSELECT CAST(count(*) AS BIGINT) AS n FROM lines",
        "tokens": WORDS_PREFIX
        + "SELECT doc_id, line_no, CAST(generate_subscripts(ts, 1) - 1 AS INTEGER) AS token_no,"
        " unnest(ts) AS word FROM token_lists",
        "doc_term_counts": WORDS_PREFIX
        + "SELECT doc_id, line_no, word, CAST(count(*) AS BIGINT) AS cnt FROM words"
        " GROUP BY doc_id, line_no, word",
        "word_count": word_count,
        "word_count_salted": word_count,
        "word_count_rand_group": word_count,
        "word_count_partition": word_count,
        "distinct_words": WORDS_PREFIX
        + "SELECT CAST(count(DISTINCT word) AS BIGINT) AS distinct_words FROM words",
        "avg_word_length": WORDS_PREFIX
        + "SELECT CASE WHEN count(*) > 0 THEN CAST(sum(length(word)) // count(*) AS BIGINT) END"
        " AS avg_word_length FROM (SELECT DISTINCT word FROM words)",
    }


# --- sales -----------------------------------------------------------------

TRANSACTIONS_CTE = """
transactions AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS transaction_id,
         CAST(l.l_partkey AS VARCHAR) AS product,
         l.l_quantity AS quantity,
         o.o_custkey AS customer,
         n.n_name AS country
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""


def _filtered(country: str, min_quantity: float) -> str:
    cond = f"quantity > {min_quantity!r}"
    if country != "all":
        cond += f" AND country = '{country}'"
    return (
        f"WITH {TRANSACTIONS_CTE},\nfiltered AS (SELECT product, customer, quantity, country"
        f" FROM transactions WHERE {cond})\n"
    )


def sales_sql(country: str, H: int, min_quantity: float) -> dict[str, str]:
    every = _filtered("all", min_quantity)
    one = _filtered(country, min_quantity)
    popularity = "SELECT product, CAST(count(DISTINCT customer) AS BIGINT) AS popularity FROM filtered GROUP BY product"
    return {
        "transactions": f"WITH {TRANSACTIONS_CTE}\nSELECT * FROM transactions",
        "sales_filtered": one + "SELECT * FROM filtered",
        "product_customer": every + "SELECT DISTINCT product, customer FROM filtered",
        "product_customer_count": every
        + "SELECT CAST(count(*) AS BIGINT) AS pairs FROM (SELECT DISTINCT product, customer FROM filtered)",
        "popularity_grouped": every + popularity,
        "popularity_reduced": every + popularity,
        "top_products": every + popularity + f" ORDER BY popularity DESC, product DESC LIMIT {H}",
        "products_listing": every + popularity + " ORDER BY product",
        "top_products_by_country": one
        + popularity
        + f" ORDER BY popularity DESC, product DESC LIMIT {H}",
    }


# --- geometry --------------------------------------------------------------


def dist(a: str, b: str) -> str:
    """Euclidean distance, squares summed left to right (same as Spark)."""
    return (
        f"sqrt(list_sum(list_transform(list_zip({a}, {b}),"
        " lambda x: (x[1] - x[2]) * (x[1] - x[2]))))"
    )


POINTS_CTE = "pts AS (SELECT vec_id AS point_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


# Row numbers in the order of the points stand in for ids, which repeat.
LINEITEM_CTE = """pts AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY id, v) AS point_id, id, v FROM (
    SELECT l_orderkey * 8 + l_linenumber AS id,
           [CAST(l_quantity AS DOUBLE), CAST(l_extendedprice AS DOUBLE), CAST(l_discount AS DOUBLE), CAST(l_tax AS DOUBLE)] AS v
    FROM lineitem))"""


def parts_sql(m: int, part_rows: int) -> str:
    """The number of parts that the number of points asks for."""
    return f"(SELECT CAST(greatest(ceil(count(*) / {float(max(part_rows, 2 * m))!r}), 1) AS BIGINT) FROM pts)"


def lineitem_sql(k: int, z: int, alpha: float, part_rows: int) -> dict[str, str]:
    """Oracles of the k-center job on lineitem, with as many parts as the
    number of points asks for."""
    m = k + z + 1
    parts = parts_sql(m, part_rows)
    head = fft_ctes(m, parts, LINEITEM_CTE, "id")
    out = kcenter_sql(k, z, parts, alpha, 1.0, head=head)
    core = (
        f"SELECT w.part, w.c, CAST(w.part * {m} + w.c AS BIGINT) AS ord, CAST(p.id AS BIGINT) AS point_id, p.v, w.w"
        " FROM wts w JOIN pts p ON p.point_id = w.point_id"
    )
    centers = out["kcenter_outliers"].rpartition("SELECT center_no, point_id FROM")
    return {
        "coreset_lineitem": head + core,
        "fft_centers_lineitem": head + f"SELECT part, c, point_id, v FROM ({core})",
        "center_weights_lineitem": head + f"SELECT part, c, point_id, w FROM ({core})",
        "guess_trace_lineitem": out["guess_trace"],
        "kcenter_outliers_lineitem": centers[0]
        + "SELECT center_no, CAST(p.id AS BIGINT) AS point_id, p.v FROM"
        + centers[2]
        + " s JOIN pts p ON p.point_id = s.point_id",
        "kcenter_report_lineitem": out["kcenter_report"],
    }


def fft_ctes(m: int, L: int | str, points: str = POINTS_CTE, key: str = "point_id") -> str:
    """Farthest-first traversal per part, unrolled into ``m`` CTE steps.

    Step t keeps each point's least distance to the centers so far; the next
    center is the point of greatest such distance, least id on ties (which
    is the part's first point when every distance is 0).
    """
    parts = [
        points,
        f"ppts AS MATERIALIZED (SELECT point_id, v, CAST((({key} % {L}) + {L}) % {L} AS INTEGER) AS part FROM pts)",
        "k0 AS (SELECT part, min(point_id) AS cid FROM ppts GROUP BY part)",
    ]
    for t in range(1, m):
        prev = "ppts" if t == 1 else f"s{t - 1}"
        md = dist("s.v", "c.v") if t == 1 else f"least(s.md, {dist('s.v', 'c.v')})"
        parts.append(
            f"s{t} AS MATERIALIZED (SELECT s.part, s.point_id, s.v, {md} AS md FROM {prev} s"
            f" JOIN k{t - 1} k ON s.part = k.part JOIN pts c ON c.point_id = k.cid)"
        )
        parts.append(
            f"k{t} AS MATERIALIZED (SELECT part, point_id AS cid FROM (SELECT part, point_id, row_number() OVER"
            f" (PARTITION BY part ORDER BY md DESC, point_id) AS rn FROM s{t}) WHERE rn = 1)"
        )
    union = " UNION ALL ".join(f"SELECT part, {t} AS c, cid FROM k{t}" for t in range(m))
    parts.append(f"fft AS (SELECT part, CAST(c AS INTEGER) AS c, cid FROM ({union}))")
    parts.append(
        f"own AS (SELECT p.part, f.c, row_number() OVER (PARTITION BY p.point_id ORDER BY"
        f" {dist('p.v', 'cv.v')}, f.c) AS rn FROM ppts p JOIN fft f ON p.part = f.part"
        " JOIN pts cv ON cv.point_id = f.cid)"
    )
    parts.append(
        "wts AS (SELECT f.part, f.c, f.cid AS point_id, CAST(coalesce(n, 0) AS BIGINT) AS w FROM fft f"
        " LEFT JOIN (SELECT part, c, count(*) AS n FROM own WHERE rn = 1 GROUP BY part, c) o"
        " ON f.part = o.part AND f.c = o.c)"
    )
    parts.append("cen AS (SELECT f.cid AS id, p.v FROM fft f JOIN pts p ON p.point_id = f.cid)")
    return "WITH " + ",\n".join(parts) + "\n"


def geometry_sql(m: int, part_rows: int, first_m: int, radius: float, z: int) -> dict[str, str]:
    head = fft_ctes(m, parts_sql(m, part_rows))
    d_pc = dist("p.v", "c.v")
    nearest = (
        f"SELECT point_id, center_id, d FROM (SELECT p.point_id, c.id AS center_id, {d_pc} AS d,"
        f" row_number() OVER (PARTITION BY p.point_id ORDER BY {d_pc}, c.id) AS rn"
        " FROM pts p, cen c) WHERE rn = 1"
    )
    farthest = f"SELECT point_id, d FROM ({nearest}) ORDER BY d DESC, point_id LIMIT {z + 1}"
    members = f"SELECT c.id AS center_id, p.point_id, CAST(1 AS BIGINT) AS w FROM pts p, cen c WHERE {d_pc} <= {radius!r}"
    weights = (
        "SELECT i.id AS center_id, CAST(coalesce(sum(m.w), 0) AS BIGINT) AS ball_weight"
        f" FROM (SELECT DISTINCT id FROM cen) i LEFT JOIN ({members}) m ON m.center_id = i.id GROUP BY i.id"
    )
    return {
        "points": f"WITH {POINTS_CTE}\nSELECT point_id, v FROM pts",
        "fft_centers": head + "SELECT part, c, cid AS point_id FROM fft",
        "center_weights": head + "SELECT part, c, point_id, w FROM wts",
        "coreset": head
        + f"SELECT part, c, CAST(part * {m} + c AS BIGINT) AS ord, point_id, w FROM wts",
        "point_distances": head
        + f"SELECT p.point_id, c.id AS center_id, {d_pc} AS dist FROM pts p, cen c",
        "initial_radius": f"WITH {POINTS_CTE}, f AS (SELECT * FROM pts ORDER BY point_id LIMIT {first_m})\n"
        f"SELECT min({dist('a.v', 'b.v')}) / 2 AS r0 FROM f a JOIN f b ON a.point_id < b.point_id",
        "ball_members": head + members,
        "ball_weights": head + weights,
        "heaviest_ball": head
        + f"SELECT * FROM ({weights}) WHERE ball_weight > 0 ORDER BY ball_weight DESC, center_id LIMIT 1",
        "uncovered_after": head
        + f"SELECT p.point_id FROM pts p WHERE NOT EXISTS (SELECT 1 FROM cen c WHERE {d_pc} <= {radius!r})",
        "nearest_center_distance": head + nearest,
        "farthest_points": head + farthest,
        "objective": head + f"SELECT min(d) AS objective FROM ({farthest})",
    }


# --- k-center solve ----------------------------------------------------------


def _greedy_ctes(p: str, guesses: str, k: int, alpha: float) -> list[str]:
    """k unrolled greedy steps for every guess in ``guesses(g, r)``.

    Step t: each candidate's ball weight over the uncovered rows within
    (1+2a)*r; the heaviest positive ball wins (least ord on ties); rows
    within (3+4a)*r of it become covered.
    """
    pick, drop = float(1 + 2 * alpha), float(3 + 4 * alpha)
    out = [f"{p}u0 AS (SELECT g.g, c.ord FROM {guesses} g, core c)"]
    for t in range(k):
        out.append(
            f"{p}bw{t} AS (SELECT u.g, pr.ca AS cand, sum(cp.w) AS bw FROM {p}u{t} u"
            f" JOIN core cp ON cp.ord = u.ord JOIN pairs pr ON pr.pb = u.ord"
            f" JOIN {guesses} gs ON gs.g = u.g WHERE pr.d <= {pick!r} * gs.r GROUP BY u.g, pr.ca)"
        )
        out.append(
            f"{p}k{t} AS (SELECT g, cand FROM (SELECT g, cand, row_number() OVER"
            f" (PARTITION BY g ORDER BY bw DESC, cand) AS rn FROM {p}bw{t} WHERE bw > 0) WHERE rn = 1)"
        )
        out.append(
            f"{p}u{t + 1} AS (SELECT u.g, u.ord FROM {p}u{t} u LEFT JOIN {p}k{t} kk ON kk.g = u.g"
            f" LEFT JOIN pairs pr ON pr.ca = kk.cand AND pr.pb = u.ord"
            f" JOIN {guesses} gs ON gs.g = u.g WHERE kk.cand IS NULL OR pr.d > {drop!r} * gs.r)"
        )
    out.append(
        f"{p}left AS (SELECT g.g, g.r, CAST(coalesce(sum(c.w), 0) AS BIGINT) AS left_over FROM {guesses} g"
        f" LEFT JOIN {p}u{k} u ON u.g = g.g LEFT JOIN core c ON c.ord = u.ord GROUP BY g.g, g.r)"
    )
    steps = " UNION ALL ".join(f"SELECT g, {t} AS step, cand FROM {p}k{t}" for t in range(k))
    out.append(f"{p}cent AS ({steps})")
    return out


def _solution_rows(p: str, z: int, last: str) -> str:
    """Rows per (guess, center) up to guess ``last`` (a scalar SQL expr)."""
    return (
        f"SELECT CAST(l.g AS INTEGER) AS guess_no, l.r, l.left_over <= {z} AS feasible, l.left_over,"
        " CAST(row_number() OVER (PARTITION BY l.g ORDER BY c.step) - 1 AS INTEGER) AS center_no,"
        " c.cand AS center_ord, core.point_id AS center_point_id"
        f" FROM {p}left l JOIN {p}cent c ON c.g = l.g JOIN core ON core.ord = c.cand"
        f" WHERE l.g <= {last}"
    )


def kcenter_sql(
    k: int, z: int, L: int | str, alpha: float, greedy_r: float, max_guesses: int = 24, head: str = ""
) -> dict[str, str]:
    """Oracles of the coreset-based solve (single coreset level).

    The coreset is the unrolled traversal of ``fft_ctes`` with m = k+z+1;
    guesses r0 * 2^g are all evaluated and the first feasible one is kept,
    which is what the sequential doubling search returns.
    """
    m = k + z + 1
    head = (head or fft_ctes(m, L)).rstrip("\n")
    base = [
        f"core AS (SELECT CAST(w.part * {m} + w.c AS BIGINT) AS ord, w.point_id, p.v, w.w"
        " FROM wts w JOIN pts p ON p.point_id = w.point_id)",
        f"pairs AS (SELECT a.ord AS ca, b.ord AS pb, {dist('a.v', 'b.v')} AS d FROM core a, core b)",
        f"firstm AS (SELECT ord FROM core ORDER BY ord LIMIT {m})",
        "r0 AS (SELECT min(d) / 2 AS r FROM pairs WHERE ca < pb AND ca IN (SELECT ord FROM firstm)"
        " AND pb IN (SELECT ord FROM firstm))",
        f"dbl AS (SELECT CAST(i AS INTEGER) AS g, (SELECT r FROM r0) * pow(2.0, i) AS r FROM range(0, {max_guesses}) t(i))",
        f"one AS (SELECT 0 AS g, CAST({greedy_r!r} AS DOUBLE) AS r)",
    ]

    def with_ctes(extra: list[str]) -> str:
        return head + ",\n" + ",\n".join(base + extra) + "\n"

    solve0 = _greedy_ctes("a0_", "dbl", k, 0)
    solve2 = _greedy_ctes("a2_", "dbl", k, alpha)
    greedy = _greedy_ctes("gr_", "one", k, alpha)
    first0 = f"(SELECT min(g) FROM a0_left WHERE left_over <= {z})"
    first2 = f"(SELECT min(g) FROM a2_left WHERE left_over <= {z})"
    trace2 = (
        "SELECT min_by(r, g) AS initial_guess, max_by(r, g) AS final_guess,"
        f" CAST(count(*) AS BIGINT) AS guesses FROM a2_left WHERE g <= {first2}"
    )
    centers2 = (
        "SELECT CAST(row_number() OVER (ORDER BY c.step) - 1 AS INTEGER) AS center_no, core.point_id, core.v"
        f" FROM a2_cent c JOIN core ON core.ord = c.cand WHERE c.g = {first2}"
    )
    d_pc = dist("p.v", "cc.v")
    farthest = (
        f"SELECT min({d_pc}) AS d, p.point_id FROM pts p, ({centers2}) cc GROUP BY p.point_id"
        f" ORDER BY d DESC, p.point_id LIMIT {z + 1}"
    )
    report = (
        "SELECT (SELECT CAST(count(*) AS BIGINT) FROM pts) AS n,"
        f" CAST({k} AS INTEGER) AS k, CAST({z} AS INTEGER) AS z, CAST({L} AS INTEGER) AS L, CAST(1 AS INTEGER) AS levels,"
        f" (SELECT max(d) FROM (SELECT min({dist('p.v', 'cv.v')}) AS d FROM ppts p JOIN fft f ON p.part = f.part"
        " JOIN pts cv ON cv.point_id = f.cid GROUP BY p.point_id)) AS coreset_radius,"
        " t.initial_guess, t.final_guess, t.guesses,"
        f" (SELECT left_over FROM a2_left WHERE g = {first2}) AS left_over,"
        f" (SELECT min(d) FROM ({farthest})) AS objective FROM ({trace2}) t"
    )
    return {
        "greedy_cover": with_ctes(greedy) + _solution_rows("gr_", z, "0"),
        "weighted_kcenter": with_ctes(solve0) + _solution_rows("a0_", z, first0),
        "guess_trace": with_ctes(solve2) + trace2,
        "kcenter_outliers": with_ctes(solve2)
        + f"SELECT center_no, point_id FROM ({centers2})",
        "kcenter_report": with_ctes(solve2) + report,
    }
