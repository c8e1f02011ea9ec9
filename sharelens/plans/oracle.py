"""The same queries as ANSI SQL over the test tables, written apart from the operators."""

from __future__ import annotations

VIEWS = {
    "log_e": """
        SELECT * FROM (
          SELECT user_id AS inviter_id, k AS item_id,
                 lead(user_id) OVER (PARTITION BY k ORDER BY ts, event_id) AS voter_id, ts, event_id
          FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) x) y
        WHERE voter_id IS NOT NULL""",
    "log_l": """
        SELECT * FROM (
          SELECT o_custkey AS inviter_id, l_partkey AS item_id,
                 lead(o_custkey) OVER (PARTITION BY l_partkey
                   ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey) AS voter_id,
                 l_shipdate AS ts
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey) y
        WHERE voter_id IS NOT NULL""",
    "users": """
        SELECT c_custkey AS user_id, CAST(c_nationkey % 3 - 1 AS INTEGER) AS user_gender,
               CAST(CASE WHEN c_custkey % 9 = 0 THEN -1 ELSE c_custkey % 9 END AS INTEGER) AS user_age,
               1 + CAST(floor(abs(c_acctbal) / 1000) AS INTEGER) AS user_level
        FROM customer""",
    "items": """
        SELECT p_partkey AS item_id, concat(p_type, '/', CAST(p_size AS VARCHAR)) AS cate_id,
               p_type AS cate_level1_id, p_brand AS brand_id, p_partkey % 10 AS shop_id
        FROM part""",
    "train": "SELECT * FROM log_e WHERE ts < TIMESTAMP '2024-01-25 00:00:00'",
    "queries": """
        SELECT CAST(event_id AS VARCHAR) AS triple_id, * FROM log_e
        WHERE ts >= TIMESTAMP '2024-01-25 00:00:00'""",
    "invites": "SELECT inviter_id AS user_id, count(*) AS invite_count FROM log_e GROUP BY 1",
    "votes": "SELECT voter_id AS user_id, count(*) AS voted_count FROM log_e GROUP BY 1",
    "activity": """
        SELECT user_id, coalesce(invite_count, 0) AS invite_count, coalesce(voted_count, 0) AS voted_count
        FROM invites FULL JOIN votes USING (user_id)""",
    "invites_u": "SELECT * FROM invites LEFT JOIN users USING (user_id)",
    "shared_items": """
        SELECT * FROM (SELECT item_id, count(*) AS share_count FROM log_l GROUP BY 1) x
        LEFT JOIN items USING (item_id)""",
    "edges": "SELECT DISTINCT inviter_id AS src, voter_id AS dst FROM log_e",
    "degrees": """
        SELECT n AS user_id, count(*) FILTER (WHERE side = 'in') AS in_degree,
               count(*) FILTER (WHERE side = 'out') AS out_degree
        FROM (SELECT dst AS n, 'in' AS side FROM edges UNION ALL SELECT src, 'out' FROM edges) x GROUP BY 1""",
    "intervals": """
        SELECT inviter_id, ts, epoch_us(ts) AS ts_micros,
               (epoch_us(ts) - epoch_us(prev)) / 3.6e9::DOUBLE AS interval_hours
        FROM (SELECT inviter_id, ts, lag(ts) OVER (PARTITION BY inviter_id ORDER BY ts) AS prev
              FROM log_e WHERE inviter_id IN
                (SELECT user_id FROM invites ORDER BY invite_count DESC, user_id LIMIT 100)) x
        WHERE prev IS NOT NULL""",
    "history": """
        SELECT triple_id, coalesce(names, '') AS candidate_voter_list, q.voter_id
        FROM queries q LEFT JOIN (
          SELECT inviter_id, string_agg(CAST(voter_id AS VARCHAR), ',' ORDER BY rank) AS names
          FROM (SELECT inviter_id, voter_id,
                       row_number() OVER (PARTITION BY inviter_id ORDER BY count(*) DESC, voter_id) AS rank
                FROM train GROUP BY inviter_id, voter_id) t
          WHERE rank <= 5 GROUP BY inviter_id) h USING (inviter_id)""",
    "history_rank": """
        SELECT triple_id, coalesce(list_position(string_split(candidate_voter_list, ','),
                                                 CAST(voter_id AS VARCHAR)), 0) AS place
        FROM history""",
    # Brute force: every query against every user.
    "scored": """
        SELECT triple_id, inviter_id, item_id, rank, voter_id, score FROM (
          SELECT *, row_number() OVER (PARTITION BY triple_id ORDER BY score DESC, voter_id) AS rank FROM (
            SELECT q.triple_id, q.inviter_id, q.item_id, u.user_id AS voter_id, greatest(
                     coalesce(pv.n / pt.n::DOUBLE, 0), coalesce(iv.n / it.n::DOUBLE, 0),
                     coalesce(v.n / (SELECT count(*) FROM train)::DOUBLE, 0)) AS score
            FROM queries q CROSS JOIN users u
            LEFT JOIN (SELECT inviter_id, voter_id, count(*) AS n FROM train GROUP BY 1, 2) pv
              ON pv.inviter_id = q.inviter_id AND pv.voter_id = u.user_id
            LEFT JOIN (SELECT inviter_id, count(*) AS n FROM train GROUP BY 1) pt ON pt.inviter_id = q.inviter_id
            LEFT JOIN (SELECT item_id, voter_id, count(*) AS n FROM train GROUP BY 1, 2) iv
              ON iv.item_id = q.item_id AND iv.voter_id = u.user_id
            LEFT JOIN (SELECT item_id, count(*) AS n FROM train GROUP BY 1) it ON it.item_id = q.item_id
            LEFT JOIN (SELECT voter_id, count(*) AS n FROM train GROUP BY 1) v ON v.voter_id = u.user_id) s) r
        WHERE rank <= 5""",
    "top50": "SELECT user_id FROM invites ORDER BY invite_count DESC, user_id LIMIT 50",
    "top100i": "SELECT item_id FROM log_e GROUP BY 1 ORDER BY count(*) DESC, item_id LIMIT 100",
    "cosines": """
        SELECT user_a, user_b, weight FROM (
          SELECT a.inviter_id AS user_a, b.inviter_id AS user_b,
                 sum(a.n * b.n) / (max(na.v) * max(nb.v)) AS weight
          FROM m a JOIN m b ON a.item_id = b.item_id AND a.inviter_id < b.inviter_id
          JOIN norms na ON na.inviter_id = a.inviter_id JOIN norms nb ON nb.inviter_id = b.inviter_id
          GROUP BY 1, 2) x WHERE weight > 0.45""",
    "m": """
        SELECT inviter_id, item_id, count(*)::DOUBLE AS n FROM log_e
        WHERE inviter_id IN (FROM top50) AND item_id IN (FROM top100i) GROUP BY 1, 2""",
    "norms": "SELECT inviter_id, sqrt(sum(n * n)) AS v FROM m GROUP BY 1",
    "top30": "SELECT user_id FROM invites ORDER BY invite_count DESC, user_id LIMIT 30",
    "top30i": "SELECT item_id FROM log_e GROUP BY 1 ORDER BY count(*) DESC, item_id LIMIT 30",
    "inside30": "SELECT * FROM log_e WHERE inviter_id IN (FROM top30) AND item_id IN (FROM top30i)",
    "matrix": """
        SELECT u.inviter_id, i.item_id, ln(1 + coalesce(n, 0)) AS log_count
        FROM (SELECT DISTINCT inviter_id FROM inside30) u CROSS JOIN (SELECT DISTINCT item_id FROM inside30) i
        LEFT JOIN (SELECT inviter_id, item_id, count(*) AS n FROM inside30 GROUP BY 1, 2) c
          ON c.inviter_id = u.inviter_id AND c.item_id = i.item_id""",
}

NEEDS = {
    "train": ["log_e"],
    "queries": ["log_e"],
    "invites": ["log_e"],
    "votes": ["log_e"],
    "activity": ["invites", "votes"],
    "invites_u": ["invites", "users"],
    "shared_items": ["log_l", "items"],
    "edges": ["log_e"],
    "degrees": ["edges"],
    "intervals": ["log_e", "invites"],
    "history": ["train", "queries"],
    "history_rank": ["history"],
    "scored": ["train", "queries", "users"],
    "top50": ["invites"],
    "top100i": ["log_e"],
    "m": ["log_e", "top50", "top100i"],
    "norms": ["m"],
    "cosines": ["m", "norms"],
    "top30": ["invites"],
    "top30i": ["log_e"],
    "inside30": ["log_e", "top30", "top30i"],
    "matrix": ["inside30"],
}


def over(views: str, body: str, more: str = "") -> str:
    """``body`` with the named views, and what they need, in front as CTEs."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in views.split():
        add(name)
    parts = [f"{name} AS ({VIEWS[name]})" for name in order]
    if more:
        parts.append(more)
    return "WITH " + ",\n".join(parts) + "\n" + body


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def merges_ctes(name: str, key: str, other: str) -> str:
    """``{name}_merges`` of average linkage, a closest pair at a time, and the leaves after each."""
    return f"""{name}_pairs AS (
          SELECT 0 AS step, a.{key} AS a, b.{key} AS b, 1 AS n,
                 CAST(round(sqrt(sum(pow(a.log_count - b.log_count, 2))) * 1000000) AS BIGINT) AS total
          FROM matrix a JOIN matrix b ON a.{other} = b.{other} AND a.{key} < b.{key} GROUP BY 2, 3
          UNION ALL
          SELECT step + 1, least(na, nb), greatest(na, nb), CAST(sum(n) AS INTEGER), CAST(sum(total) AS BIGINT)
          FROM (SELECT step, n, total, CASE WHEN a = mb THEN ma ELSE a END AS na,
                       CASE WHEN b = mb THEN ma ELSE b END AS nb
                FROM (SELECT *, first_value(a) OVER w AS ma, first_value(b) OVER w AS mb
                      FROM {name}_pairs WINDOW w AS (ORDER BY total / n, a, b)) x) y
          WHERE na <> nb GROUP BY 1, 2, 3),
        {name}_merges AS (
          SELECT step, a, b, total / n / 1000000 AS height FROM {name}_pairs
          QUALIFY row_number() OVER (PARTITION BY step ORDER BY total / n, a, b) = 1),
        {name}_leaves AS (
          SELECT DISTINCT 0 AS step, {key} AS member, {key} AS cluster, 0::BIGINT AS place FROM matrix
          UNION ALL
          SELECT l.step + 1, member, CASE WHEN cluster = b THEN a ELSE cluster END,
                 place + CASE WHEN cluster = b THEN count(*) FILTER (WHERE cluster = a) OVER () ELSE 0 END
          FROM {name}_leaves l JOIN {name}_merges m ON m.step = l.step)"""


def cluster_tree(key: str, other: str) -> str:
    return recursive(over(
        "matrix",
        """SELECT a AS cluster_a, b AS cluster_b, round(height, 6) AS height,
                  (SELECT count(*) FROM t_leaves l WHERE l.step = m.step + 1 AND l.cluster = m.a) AS n_members
           FROM t_merges m""",
        merges_ctes("t", key, other),
    ))


GENDER = "CASE user_gender WHEN -1 THEN 'unknown' WHEN 0 THEN 'female' WHEN 1 THEN 'male' END"
AGE = "CASE WHEN user_age = -1 THEN 'unknown' ELSE concat('age group ', user_age) END"
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def weekday_name(day: str) -> str:
    return f"CASE {day} " + " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(DAYS)) + " END"


DOW = "CAST(isodow(ts) - 1 AS INTEGER)"
HOUR = "CAST(hour(ts) AS INTEGER)"
BUCKET = """CASE WHEN {0} < 10 THEN '<10' WHEN {0} < 50 THEN '10-50' WHEN {0} < 100 THEN '50-100'
            WHEN {0} < 500 THEN '100-500' ELSE '>500' END"""
RANK = """CAST(CASE WHEN {0} < 10 THEN 0 WHEN {0} < 50 THEN 1 WHEN {0} < 100 THEN 2
          WHEN {0} < 500 THEN 3 ELSE 4 END AS INTEGER)"""
SHARE_TEXT = """CAST(inviter_id AS VARCHAR) AS inviter_id, CAST(item_id AS VARCHAR) AS item_id,
                CAST(voter_id AS VARCHAR) AS voter_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp\""""


def box(views: str, source: str, group: str, value: str, where: str = "TRUE") -> str:
    near = "x >= q1 - (q3 - q1) * 1.5 AND x <= q3 + (q3 - q1) * 1.5"
    return over(
        views,
        f"""
        SELECT g AS {group}, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
          round(least(q1, min(x) FILTER (WHERE {near})), 6) AS whisker_low,
          round(greatest(q3, max(x) FILTER (WHERE {near})), 6) AS whisker_high,
          count(*) AS n, count(*) FILTER (WHERE NOT ({near})) AS outliers
        FROM v JOIN q USING (g) GROUP BY g, q1, med, q3""",
        f"""v AS (SELECT {group} AS g, {value}::DOUBLE AS x FROM {source} WHERE {group} IS NOT NULL AND {where}),
        q AS (SELECT g, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med, quantile_cont(x, 0.75) AS q3
              FROM v GROUP BY g)""",
    )


def hist(views: str, values: str, bins: int) -> str:
    return over(
        views,
        f"""
        SELECT CAST(b AS INTEGER) AS bin, round(lo + (hi - lo) * b / {bins}, 6) AS bin_start,
               round(lo + (hi - lo) * (b + 1) / {bins}, 6) AS bin_end,
               (SELECT count(*) FROM v
                WHERE least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) = b) AS n
        FROM range({bins}) t(b), lim""",
        f"""v AS (SELECT x::DOUBLE AS x FROM ({values}) y),
        lim AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                       CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v)""",
    )


def kde(views: str, values: str) -> str:
    return over(
        views,
        """
        SELECT CAST(p AS INTEGER) AS point, round(lo + p * (hi - lo) / 199, 6) AS x,
               round((SELECT sum(exp(-0.5 * pow((lo + p * (hi - lo) / 199 - v.x) / h, 2))) FROM v)
                     / (n * h * sqrt(2 * pi())), 6) AS density
        FROM range(200) t(p), lim""",
        f"""v AS (SELECT x::DOUBLE AS x FROM ({values}) y),
        lim AS (SELECT min(x) AS lo, max(x) AS hi, count(*) AS n,
                       pow(count(*), -0.2) * stddev_samp(x) AS h FROM v)""",
    )


def kde_groups(group: str, where: str = "TRUE") -> str:
    return over(
        "invites_u",
        f"""
        SELECT g AS {group}, CAST(p AS INTEGER) AS point, round(lo + p * (hi - lo) / 99, 6) AS x,
               round((SELECT sum(exp(-0.5 * pow((lo + p * (hi - lo) / 99 - v.x) / h, 2))) FROM v WHERE v.g = lim.g)
                     / (n * h * sqrt(2 * pi())), 6) AS density
        FROM range(100) t(p), lim""",
        f"""v AS (SELECT {group} AS g, invite_count::DOUBLE AS x FROM invites_u
                  WHERE {group} IS NOT NULL AND {where}),
        lim AS (SELECT g, min(x) AS lo, max(x) AS hi, count(*) AS n,
                       pow(count(*), -0.2) * stddev_samp(x) AS h
                FROM v GROUP BY g HAVING count(*) > 1 AND max(x) > min(x))""",
    )


def gender_stats(where: str) -> str:
    return over(
        "invites_u",
        f"""SELECT {GENDER} AS gender, round(avg(invite_count), 6) AS mean,
                   round(median(invite_count::DOUBLE), 6) AS median, count(*) AS inviters
            FROM invites_u WHERE user_gender IS NOT NULL AND {where} GROUP BY 1""",
    )


def top(source: str, view: str, column: str) -> str:
    return over(
        view,
        f"""SELECT {column}, count(*) AS n FROM {source} WHERE {column} IS NOT NULL
            GROUP BY 1 ORDER BY n DESC, {column} LIMIT 20""",
    )


def average_by(column: str) -> str:
    return over(
        "shared_items",
        f"""SELECT {column}, round(a, 6) AS avg_shares FROM (
              SELECT {column}, avg(share_count) AS a FROM shared_items WHERE {column} IS NOT NULL
              GROUP BY 1 ORDER BY a DESC, {column} LIMIT 20) x""",
    )


def return_rate(key: str, name: str) -> str:
    return f"""SELECT {key}, count(*) AS {name}, count(DISTINCT voter_id) AS unique_voters,
               count(DISTINCT voter_id) / count(*)::DOUBLE AS return_rate FROM log_l GROUP BY 1"""


def regression(x: str, y: str) -> str:
    return over(
        "log_l",
        f"""SELECT round(regr_slope({y}, {x}), 6) AS slope, round(regr_intercept({y}, {x}), 6) AS intercept,
                   count(*) AS items FROM ({return_rate('item_id', 'shares')} HAVING count(*) >= 25) r""",
    )


def fraction(key: str) -> str:
    return f"CAST('0x' || substr(md5('42|' || {key}), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE"


MODEL_FEATURES = ["pair_share", "item_share", "vote_share", "gender_affinity", "age_affinity", "level_affinity"]


def feature_ctes(log: str) -> str:
    """The model's features from the shares ``log``, as tables whose names begin with it."""
    traits = ["gender", "age", "level"]
    met = " UNION ALL ".join(
        f"""SELECT '{t}' AS trait, coalesce(a.user_{t}, -1) AS own, b.user_{t} AS other, count(*) AS n
            FROM {log} s LEFT JOIN users a ON a.user_id = s.inviter_id LEFT JOIN users b ON b.user_id = s.voter_id
            GROUP BY 1, 2, 3"""
        for t in traits
    )
    sizes = " UNION ALL ".join(f"SELECT '{t}' AS trait, user_{t} AS other, count(*) AS size FROM users GROUP BY 1, 2" for t in traits)
    return f"""
        {log}_pairs AS (SELECT inviter_id, voter_id, count(*) AS n FROM {log} GROUP BY 1, 2),
        {log}_items AS (SELECT item_id, voter_id, count(*) AS n FROM {log} GROUP BY 1, 2),
        {log}_inviters AS (SELECT inviter_id, count(*) AS total FROM {log} GROUP BY 1),
        {log}_popular AS (SELECT item_id, count(*) AS total FROM {log} GROUP BY 1),
        {log}_votes AS (SELECT voter_id, count(*) AS n FROM {log} GROUP BY 1),
        {log}_met AS ({met}),
        {log}_sizes AS ({sizes}),
        {log}_rates AS (
            SELECT trait, own, other, (n / own_total::DOUBLE) / (size / (SELECT count(*) FROM users)::DOUBLE) AS rate
            FROM (SELECT *, sum(n) OVER (PARTITION BY trait, own) AS own_total FROM {log}_met) m
            JOIN {log}_sizes USING (trait, other))"""


def features_of(log: str, rows: str) -> str:
    """``rows`` (inviter_id, item_id, voter_id and more) with the features."""
    affinities = ", ".join(f"coalesce({t}.rate, 0) AS {t}_affinity" for t in ("gender", "age", "level"))
    joins = "\n".join(
        f"""LEFT JOIN {log}_rates {t} ON {t}.trait = '{t}' AND {t}.other = v.user_{t}
            AND {t}.own = CASE WHEN it.inviter_id IS NOT NULL THEN coalesce(i.user_{t}, -1) END"""
        for t in ("gender", "age", "level")
    )
    return f"""
        SELECT r.*, coalesce(p.n / it.total::DOUBLE, 0) AS pair_share, coalesce(im.n / po.total::DOUBLE, 0) AS item_share,
               coalesce(vo.n / (SELECT count(*) FROM {log})::DOUBLE, 0) AS vote_share, {affinities}
        FROM {rows} r
        LEFT JOIN {log}_pairs p ON p.inviter_id = r.inviter_id AND p.voter_id = r.voter_id
        LEFT JOIN {log}_items im ON im.item_id = r.item_id AND im.voter_id = r.voter_id
        LEFT JOIN {log}_inviters it ON it.inviter_id = r.inviter_id
        LEFT JOIN {log}_popular po ON po.item_id = r.item_id
        LEFT JOIN {log}_votes vo ON vo.voter_id = r.voter_id
        LEFT JOIN users i ON i.user_id = r.inviter_id
        LEFT JOIN users v ON v.user_id = r.voter_id
        {joins}"""


def weight_ctes(rows: str, sweeps: int = 200) -> str:
    """``model``: least-squares weights of the features of ``rows``, none below 0, one set after the other."""
    n = len(MODEL_FEATURES)
    cov = [
        f"covar_pop({a}, {b}) AS c{i}_{j}"
        for i, a in enumerate(MODEL_FEATURES)
        for j, b in enumerate([*MODEL_FEATURES, "label"])
        if i <= j
    ]

    def best(j: int) -> str:
        others = " + ".join(f"c{min(j, k)}_{max(j, k)} * {'n' if k < j else 'w'}{k}" for k in range(n) if k != j)
        return f"CASE WHEN c{j}_{j} > 1e-15 THEN greatest(0.0::DOUBLE, (c{j}_{n} - ({others})) / c{j}_{j}) ELSE 0.0::DOUBLE END AS n{j}"

    zero = " AND ".join(f"round(w{j}, 6) = 0" for j in range(n))
    return f"""
        cov AS (SELECT {", ".join(cov)} FROM {rows}),
        sweep(step, {", ".join(f"w{j}" for j in range(n))}) AS (
            SELECT 0, {", ".join(["0.0::DOUBLE"] * n)}
            UNION ALL SELECT step + 1, {", ".join(f"n{j}" for j in range(n))}
            FROM (SELECT step, {", ".join(best(j) for j in range(n))} FROM sweep, cov WHERE step < {sweeps}) s),
        model AS (
            SELECT {", ".join(f"CASE WHEN {zero} THEN 1.0::DOUBLE ELSE round(w{j}, 6) END AS w{j}" for j in range(n))}
            FROM sweep WHERE step = {sweeps})"""


def trained_ranking(label_start: str, k: int = 5) -> str:
    """Every user scored for every query by the weights learned from the later train shares."""
    fraction_of = (
        "CAST('0x' || substr(md5('42|' || inviter_id || '|' || item_id || '|' || voter_id || '|' || ts || '|' || draw), 1, 8)"
        " AS BIGINT) / 4294967296.0::DOUBLE"
    )
    score = " + ".join(f"CAST(round(w{j} * {f} * 1e9::DOUBLE) AS BIGINT)" for j, f in enumerate(MODEL_FEATURES))
    more = f"""
        early AS (SELECT * FROM train WHERE ts < TIMESTAMP '{label_start}'),
        late AS (SELECT * FROM train WHERE ts >= TIMESTAMP '{label_start}'),
        numbered AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS idx FROM users),
        drawn AS (
            SELECT inviter_id, item_id, voter_id, CAST(floor({fraction_of} * (SELECT count(*) FROM users)) AS BIGINT) AS idx
            FROM (SELECT *, unnest([1, 2, 3, 4]) AS draw FROM late) d),
        labelled AS (
            SELECT inviter_id, item_id, voter_id, 1.0::DOUBLE AS label FROM late
            UNION ALL SELECT inviter_id, item_id, user_id, 0.0::DOUBLE FROM drawn JOIN numbered USING (idx) WHERE user_id <> voter_id),
        {feature_ctes("early")},
        described AS ({features_of("early", "labelled")}),
        {weight_ctes("described")},
        {feature_ctes("train")},
        everyone AS (SELECT triple_id, inviter_id, item_id, user_id AS voter_id FROM queries CROSS JOIN users),
        described_all AS ({features_of("train", "everyone")}),
        points AS (SELECT triple_id, voter_id, {score} AS points FROM described_all, model)"""
    sql = over(
        "train queries users",
        f"""SELECT triple_id, CAST(rank AS INTEGER) AS rank, voter_id, round(points / 1e9::DOUBLE, 6) AS score
            FROM (SELECT *, row_number() OVER (PARTITION BY triple_id ORDER BY points DESC, voter_id) AS rank FROM points) p
            WHERE rank <= {k}""",
        more.strip(),
    )
    return recursive(sql)


def embedding_ctes(log: str, dimensions: int = 8, layers: int = 2) -> str:
    """``user_vectors`` and ``item_vectors`` (node, e0, ...): mean of the layers, each from the one before."""
    each = range(dimensions)

    def first(kind: str, node: str) -> str:
        parts = [f"{fraction(f"'{kind}' || {node} || '|{d}'")} - 0.5::DOUBLE AS e{d}" for d in each]
        return f"SELECT {node} AS node, {', '.join(parts)} FROM (SELECT DISTINCT {node} FROM links) n"

    def passed(source: str, other: str, node: str) -> str:
        sums = ", ".join(f"sum(e{d} * weight) AS e{d}" for d in each)
        return f"SELECT {node} AS node, {sums} FROM weighed JOIN {source} s ON s.node = weighed.{other} GROUP BY 1"

    ctes = [
        f"links AS (SELECT inviter_id AS user_id, item_id FROM {log} UNION SELECT voter_id, item_id FROM {log})",
        """weighed AS (
             SELECT user_id, item_id, 1 / sqrt((count(*) OVER (PARTITION BY user_id) * count(*) OVER (PARTITION BY item_id))::DOUBLE)
                      AS weight FROM links)""",
        f"u0 AS ({first('u', 'user_id')})",
        f"i0 AS ({first('i', 'item_id')})",
    ]
    for n in range(layers):
        ctes.append(f"u{n + 1} AS ({passed(f'i{n}', 'item_id', 'user_id')})")
        ctes.append(f"i{n + 1} AS ({passed(f'u{n}', 'user_id', 'item_id')})")
    means = ", ".join(f"sum(e{d}) / {layers + 1} AS e{d}" for d in each)
    for side, name in (("u", "user_vectors"), ("i", "item_vectors")):
        union = " UNION ALL ".join(f"SELECT * FROM {side}{n}" for n in range(layers + 1))
        ctes.append(f"{name} AS (SELECT node, {means} FROM ({union}) x GROUP BY 1)")
    return ",\n".join(ctes)


def embedding_rows(dimensions: int = 8) -> str:
    parts = ", ".join(f"round(e{d}, 6) + 0.0::DOUBLE AS e{d}" for d in range(dimensions))
    return f"SELECT 'user' AS kind, node, {parts} FROM user_vectors UNION ALL SELECT 'item', node, {parts} FROM item_vectors"


def embedding_ranking(k: int = 5, dimensions: int = 8) -> str:
    """Every user's inner product with every query, in whole millionths of both."""

    def whole(table: str, d: int) -> str:
        return f"CAST(round({table}.e{d} * 1000000) AS BIGINT)"

    dot = " + ".join(
        f"(coalesce({whole('a', d)}, 0) + coalesce({whole('b', d)}, 0)) * {whole('u', d)}" for d in range(dimensions)
    )
    return f"""
        SELECT triple_id, CAST(rank AS INTEGER) AS rank, voter_id, round(points / 1e12::DOUBLE, 6) AS score FROM (
          SELECT *, row_number() OVER (PARTITION BY triple_id ORDER BY points DESC, voter_id) AS rank FROM (
            SELECT triple_id, u.node AS voter_id, {dot} AS points
            FROM queries q LEFT JOIN user_vectors a ON a.node = q.inviter_id LEFT JOIN item_vectors b ON b.node = q.item_id
            CROSS JOIN user_vectors u WHERE a.node IS NOT NULL OR b.node IS NOT NULL) p) r
        WHERE rank <= {k}"""


def betweenness_ctes(n_nodes: int, depth: int = 12) -> str:
    """Unrolled breadth-first levels, then the sum over all (source, target) pairs."""
    ctes = [
        f"""nodes AS (SELECT user_id FROM degrees ORDER BY md5('42|' || user_id), user_id LIMIT {n_nodes})""",
        """links AS (SELECT src, dst FROM edges WHERE src <> dst
                     AND src IN (FROM nodes) AND dst IN (FROM nodes))""",
        "r0 AS (SELECT user_id AS s, user_id AS v, 0 AS d, 1.0::DOUBLE AS sigma FROM nodes)",
        "p0 AS (SELECT * FROM r0)",
    ]
    for i in range(1, depth + 1):
        ctes.append(
            f"""r{i} AS (SELECT s, dst AS v, {i} AS d, sum(sigma) AS sigma FROM r{i - 1} JOIN links ON src = v
                 WHERE NOT EXISTS (SELECT 1 FROM p{i - 1} p WHERE p.s = r{i - 1}.s AND p.v = dst)
                 GROUP BY s, dst)"""
        )
        ctes.append(f"p{i} AS (SELECT * FROM p{i - 1} UNION ALL SELECT * FROM r{i})")
    ctes.append(
        f"""central AS (
          SELECT user_id, coalesce(b, 0) * CASE WHEN (SELECT count(*) FROM nodes) > 2
                   THEN 1.0 / (((SELECT count(*) FROM nodes) - 1) * ((SELECT count(*) FROM nodes) - 2))
                   ELSE 1.0 END AS betweenness
          FROM nodes LEFT JOIN (
            SELECT sv.v, sum(sv.sigma * vt.sigma / st.sigma) AS b
            FROM p{depth} sv JOIN p{depth} vt ON vt.s = sv.v JOIN p{depth} st ON st.s = sv.s AND st.v = vt.v
            WHERE sv.d > 0 AND vt.d > 0 AND st.d = sv.d + vt.d GROUP BY 1) x ON x.v = user_id)"""
    )
    return ",\n".join(ctes)


CELLS = {h: f"count(*) FILTER (WHERE hour(ts) = {h}) AS h{h:02d}" for h in range(24)}
DAY_TEXT = "strftime(ts, '%Y-%m-%d')"


def json_share(n: str, a: str = "inviter_id", b: str = "voter_id") -> str:
    """A share as the JSON text that the mixed file has."""
    return f"""'{{"inviter_id":"' || {a} || '","item_id":"' || item_id || '","voter_id":"' || {b} || '","timestamp":"'
        || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","n":' || {n} || '}}'"""


_ONE = json_share("event_id % 100")
MIXED_LINE = f"""CASE hour(ts)
    WHEN 0 THEN rtrim({_ONE}, '}}') WHEN 1 THEN '  ' WHEN 3 THEN '[]' WHEN 4 THEN CAST(event_id AS VARCHAR)
    WHEN 2 THEN '[' || {_ONE} || ',' || {json_share("event_id % 100", "voter_id", "inviter_id")} || ']'
    WHEN 5 THEN {json_share("'\"' || event_id % 100 || '\"'")} WHEN 6 THEN {json_share("'\"x\"'")}
    WHEN 7 THEN {json_share("'3.5'")}
    WHEN 8 THEN '[' || {_ONE} || ', 5, ' || {json_share("'\"x\"'", "voter_id", "inviter_id")} || ']'
    ELSE {_ONE} END"""
LOST = f"""lost AS (
    SELECT {DAY_TEXT} AS "day", CAST(NULL AS VARCHAR) AS field, CASE hour(ts) WHEN 8 THEN '5'
             WHEN 4 THEN CAST(event_id AS VARCHAR) ELSE substr(rtrim({_ONE}, '}}'), 1, 100) END AS text
    FROM log_e WHERE hour(ts) IN (0, 4, 8)
    UNION ALL
    SELECT {DAY_TEXT}, 'n', CASE WHEN hour(ts) = 7 THEN '3.5' ELSE 'x' END FROM log_e WHERE hour(ts) IN (6, 7, 8))"""
AGE_CELLS = """cells AS (
    SELECT user_gender, user_age, count(u.user_id) AS n
    FROM (SELECT DISTINCT user_gender FROM users) CROSS JOIN (SELECT DISTINCT user_age FROM users)
    LEFT JOIN users u USING (user_gender, user_age) GROUP BY 1, 2)"""

ORACLE_SQL: dict[str, str] = {
    # --- sources and sinks
    "read_jsonl": over(
        "log_e",
        f"""SELECT {SHARE_TEXT}, CASE WHEN hour(ts) NOT IN (6, 7) THEN CAST(event_id % 100 AS INTEGER) END AS n
            FROM log_e WHERE hour(ts) = 2 OR hour(ts) >= 5
            UNION ALL
            SELECT CAST(voter_id AS VARCHAR), CAST(item_id AS VARCHAR), CAST(inviter_id AS VARCHAR),
                   strftime(ts, '%Y-%m-%d %H:%M:%S'),
                   CASE WHEN hour(ts) = 2 THEN CAST(event_id % 100 AS INTEGER) END
            FROM log_e WHERE hour(ts) IN (2, 8)""",
    ),
    "jsonl_rejects": over("log_e", "SELECT * FROM lost", LOST),
    "jsonl_reject_counts": over(
        "log_e",
        """SELECT "day", count(*) FILTER (WHERE field IS NULL) AS records, count(field) AS fields
           FROM lost GROUP BY 1""",
        LOST,
    ),
    "jsonl_peek": over(
        "log_e",
        f"""SELECT "day", CAST(r AS INTEGER) AS line_no, {MIXED_LINE} AS value
            FROM (SELECT *, {DAY_TEXT} AS "day", row_number() OVER (PARTITION BY {DAY_TEXT} ORDER BY event_id) AS r
                  FROM log_e) x WHERE r <= 5""",
    ),
    "repair_columns": over("log_e", f"SELECT {SHARE_TEXT} FROM log_e"),
    "read_query_array": over(
        "queries",
        """SELECT triple_id, CAST(inviter_id AS VARCHAR) AS inviter_id, CAST(item_id AS VARCHAR) AS item_id,
                  strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp" FROM queries""",
    ),
    "assign_query_id": over(
        "queries",
        """SELECT inviter_id, item_id, event_id,
                  CAST(row_number() OVER (ORDER BY ts, event_id) - 1 AS VARCHAR) AS triple_id FROM queries""",
    ),
    "write_feature_csv": over("activity", "SELECT * FROM activity"),
    "feature_tables": over(
        "train queries items",
        """SELECT 'user_item_matrix' AS feature_table, count(*) AS n
             FROM (SELECT DISTINCT inviter_id, item_id FROM train) a
           UNION ALL SELECT 'user_item_freq', count(*) FROM (SELECT DISTINCT inviter_id, item_id FROM train) a
           UNION ALL SELECT 'user_user_matrix', count(*) FROM (SELECT DISTINCT inviter_id, voter_id FROM train) a
           UNION ALL SELECT 'user_activity', count(*)
             FROM (SELECT inviter_id FROM train UNION SELECT voter_id FROM train) a
           UNION ALL SELECT 'network_features', count(*)
             FROM (SELECT inviter_id FROM train UNION SELECT voter_id FROM train) a
           UNION ALL SELECT 'item_popularity', count(DISTINCT item_id) FROM train
           UNION ALL SELECT 'user_cate_freq', count(*)
             FROM (SELECT DISTINCT inviter_id, cate_id FROM train JOIN items USING (item_id)) a
           UNION ALL SELECT 'user_cate1_freq', count(*)
             FROM (SELECT DISTINCT inviter_id, cate_level1_id FROM train JOIN items USING (item_id)) a
           UNION ALL SELECT 'test_features', count(*) FROM queries""",
    ),
    "write_candidates_jsonl": over("history", "SELECT triple_id, candidate_voter_list FROM history"),
    "write_predictions": over(
        "scored",
        """SELECT triple_id, string_agg(CAST(voter_id AS VARCHAR), ',' ORDER BY rank) AS candidate_voter_list
           FROM scored GROUP BY 1""",
    ),
    # --- projections, scalar functions, filters
    "parse_timestamp": over("log_e", "SELECT event_id, date_trunc('second', ts) AS ts FROM log_e"),
    "calendar_features": over(
        "log_e",
        f"""SELECT event_id, CAST(ts AS DATE) AS "date", {HOUR} AS hour, {DOW} AS day_of_week,
                   CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day FROM log_e""",
    ),
    "month_day_label": over("log_e", "SELECT event_id, strftime(ts, '%m-%d') AS date_label FROM log_e"),
    "label_gender": over("users", f"SELECT user_id, {GENDER} AS gender FROM users"),
    "label_age": over("users", f"SELECT user_id, {AGE} AS age FROM users"),
    "label_weekday": over("log_e", f"SELECT event_id, {weekday_name(DOW)} AS weekday FROM log_e"),
    "share_count_bucket": over(
        "log_l",
        f"""SELECT inviter_id AS user_id, count(*) AS invite_count, {BUCKET.format('count(*)')} AS share_group,
                   {RANK.format('count(*)')} AS bucket_rank FROM log_l GROUP BY 1""",
    ),
    "log1p_counts": over(
        "activity",
        """SELECT *, round(ln(1 + invite_count), 6) AS log_invite_count,
                  round(ln(1 + voted_count), 6) AS log_voted_count FROM activity""",
    ),
    "limit_range_filter": over("invites", "SELECT * FROM invites WHERE invite_count <= 60"),
    # --- joins
    "join_share_user_item": over(
        "log_e users items",
        """SELECT s.inviter_id, s.item_id, s.voter_id, s.event_id, user_gender, user_age, user_level,
                  cate_id, cate_level1_id, brand_id, shop_id
           FROM log_e s LEFT JOIN users u ON u.user_id = s.inviter_id LEFT JOIN items i ON i.item_id = s.item_id""",
    ),
    "user_activity": over("activity", "SELECT * FROM activity"),
    "test_feature_join": over(
        "train queries users items",
        """SELECT q.triple_id, q.inviter_id, q.item_id, user_gender, user_age, user_level,
                  cate_id, cate_level1_id, brand_id, shop_id, invite_count, voted_count, item_popularity
           FROM queries q LEFT JOIN users u ON u.user_id = q.inviter_id LEFT JOIN items i ON i.item_id = q.item_id
           LEFT JOIN (SELECT inviter_id AS k, count(*) AS invite_count FROM train GROUP BY 1) a ON a.k = q.inviter_id
           LEFT JOIN (SELECT voter_id AS k, count(*) AS voted_count FROM train GROUP BY 1) b ON b.k = q.inviter_id
           LEFT JOIN (SELECT item_id AS k, count(*) AS item_popularity FROM train GROUP BY 1) c ON c.k = q.item_id""",
    ),
    "has_interaction": over(
        "train queries",
        """SELECT triple_id, inviter_id, item_id, CAST(EXISTS (SELECT 1 FROM train t
             WHERE t.inviter_id = q.inviter_id AND t.item_id = q.item_id) AS INTEGER) AS has_interaction
           FROM queries q""",
    ),
    "count_with_user_attr": over("invites_u", "SELECT * FROM invites_u"),
    "count_with_item_attr": over("shared_items", "SELECT * FROM shared_items"),
    "topn_filter": over("inside30", "SELECT inviter_id, item_id, voter_id, event_id FROM inside30"),
    "remaining_users": over(
        "history users",
        """SELECT * FROM users WHERE CAST(user_id AS VARCHAR) NOT IN
             (SELECT unnest(string_split(candidate_voter_list, ',')) FROM history)""",
    ),
    # --- aggregations
    "gender_distribution": over(
        "users",
        f"""SELECT user_gender, {GENDER} AS gender, count(*) AS n,
                   round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM users), 6) AS percent
            FROM users GROUP BY 1, 2""",
    ),
    "age_distribution": over("users", f"SELECT user_age, {AGE} AS age, count(*) AS n FROM users GROUP BY 1, 2"),
    "level_distribution": over("users", "SELECT user_level, count(*) AS n FROM users GROUP BY 1"),
    "top_categories": top("items", "items", "cate_id"),
    "top_level1_categories": top("items", "items", "cate_level1_id"),
    "top_brands": top("items", "items", "brand_id"),
    "top_inviters": top("log_e", "log_e", "inviter_id"),
    "top_voters": top("log_e", "log_e", "voter_id"),
    "top_items": top("log_l", "log_l", "item_id"),
    "daily_counts": over(
        "log_e",
        """SELECT CAST(ts AS DATE) AS "date", count(*) AS n,
             round((SELECT count(*) / count(DISTINCT CAST(ts AS DATE))::DOUBLE FROM log_e), 6) AS mean_n
           FROM log_e GROUP BY 1""",
    ),
    "hourly_counts": over(
        "log_e",
        f"""SELECT hour, n, row_number() OVER (ORDER BY n DESC, hour) = 1 AS is_peak
            FROM (SELECT {HOUR} AS hour, count(*) AS n FROM log_e GROUP BY 1) x""",
    ),
    "weekday_counts": over(
        "log_e",
        f"""SELECT CAST(d AS INTEGER) AS day_of_week, {weekday_name('d')} AS weekday,
                   (SELECT count(*) FROM log_e WHERE isodow(ts) - 1 = d) AS n FROM range(7) t(d)""",
    ),
    "weekend_effect": over(
        "log_e",
        """SELECT round(w, 6) AS workday_mean, round(e, 6) AS weekend_mean,
                  round((e - w) / nullif(w, 0) * 100, 6) AS diff_percent
           FROM (SELECT count(*) FILTER (WHERE isodow(ts) < 6) / 5.0::DOUBLE AS w,
                        count(*) FILTER (WHERE isodow(ts) >= 6) / 2.0::DOUBLE AS e FROM log_e) x""",
    ),
    "activity_stats": over(
        "invites votes",
        """SELECT 'inviter' AS role, round(avg(invite_count), 6) AS mean,
                  round(median(invite_count::DOUBLE), 6) AS median, max(invite_count) AS max FROM invites
           UNION ALL SELECT 'voter', round(avg(voted_count), 6), round(median(voted_count::DOUBLE), 6),
                  max(voted_count) FROM votes""",
    ),
    "dataset_stats": over(
        "train queries users items",
        """SELECT count(*) AS train_rows, (SELECT count(*) FROM queries) AS query_rows,
                  (SELECT count(*) FROM users) AS users, (SELECT count(*) FROM items) AS items,
                  count(DISTINCT inviter_id) AS inviters, count(DISTINCT voter_id) AS voters,
                  round(count(inviter_id) / count(DISTINCT inviter_id)::DOUBLE, 6) AS mean_shares_per_inviter,
                  round(count(voter_id) / count(DISTINCT voter_id)::DOUBLE, 6) AS mean_votes_per_voter,
                  count(DISTINCT item_id) AS shared_items FROM train""",
    ),
    "gender_activity_stats": gender_stats("TRUE"),
    "gender_activity_stats_limited": gender_stats("invite_count <= 60"),
    "box_by_category": box(
        "shared_items",
        "shared_items",
        "cate_id",
        "share_count",
        """cate_id IN (SELECT cate_id FROM shared_items WHERE cate_id IS NOT NULL
                       GROUP BY 1 ORDER BY count(*) DESC, cate_id LIMIT 10)""",
    ),
    "avg_shares_by_category": average_by("cate_id"),
    "avg_shares_by_level1": average_by("cate_level1_id"),
    "avg_shares_by_brand": average_by("brand_id"),
    "category_trend": over(
        "log_l items",
        """SELECT CAST(ts AS DATE) AS "date", cate_id, count(*) AS "count"
           FROM log_l JOIN items USING (item_id)
           WHERE cate_id IN (SELECT cate_id FROM log_l JOIN items USING (item_id)
                             GROUP BY 1 ORDER BY count(*) DESC, cate_id LIMIT 5)
           GROUP BY 1, 2""",
    ),
    "inviter_return_rate": over(
        "log_l",
        f"SELECT * REPLACE (round(return_rate, 6) AS return_rate) FROM ({return_rate('inviter_id', 'total_shares')}) x",
    ),
    "return_rate_by_activity": over(
        "log_l",
        f"""SELECT {BUCKET.format('total_shares')} AS share_group, round(avg(return_rate), 6) AS avg_return_rate,
                   count(*) AS inviters, {RANK.format('total_shares')} AS bucket_rank
            FROM ({return_rate('inviter_id', 'total_shares')}) x GROUP BY 1, 4""",
    ),
    "item_return_rate": over(
        "log_l",
        f"""SELECT * REPLACE (round(return_rate, 6) AS return_rate)
            FROM ({return_rate('item_id', 'shares')} HAVING count(*) >= 25) x""",
    ),
    "share_voter_regression": regression("shares", "unique_voters"),
    "share_voter_regression_log": regression("ln(1 + shares)", "ln(1 + unique_voters)"),
    "user_item_counts": over(
        "log_l", "SELECT inviter_id, item_id, count(*) AS interaction_count FROM log_l GROUP BY 1, 2"
    ),
    "user_user_counts": over(
        "log_e", "SELECT inviter_id, voter_id, count(*) AS interaction_count FROM log_e GROUP BY 1, 2"
    ),
    "user_category_counts": over(
        "log_l items",
        """SELECT inviter_id, cate_id, count(*) AS cate_interaction_freq
           FROM log_l JOIN items USING (item_id) GROUP BY 1, 2""",
    ),
    "user_level1_counts": over(
        "log_l items",
        """SELECT inviter_id, cate_level1_id, count(*) AS cate1_interaction_freq
           FROM log_l JOIN items USING (item_id) GROUP BY 1, 2""",
    ),
    "item_popularity": over("log_l", "SELECT item_id, count(*) AS item_popularity FROM log_l GROUP BY 1"),
    "user_item_preference": over(
        "log_l",
        """SELECT inviter_id, CAST(place // 10000 AS INTEGER) AS part,
                  string_agg(item_id || ':' || n, ',' ORDER BY item_id) AS preference
           FROM (SELECT inviter_id, item_id, count(*) AS n,
                        row_number() OVER (PARTITION BY inviter_id ORDER BY item_id) - 1 AS place
                 FROM log_l GROUP BY 1, 2) x GROUP BY 1, 2""",
    ),
    # --- crosstabs
    "hour_weekday_matrix": over(
        "log_e",
        f"SELECT {HOUR} AS hour, "
        + ", ".join(f'count(*) FILTER (WHERE isodow(ts) = {i + 1}) AS "{d}"' for i, d in enumerate(DAYS))
        + " FROM log_e GROUP BY 1",
    ),
    "hour_weekday_hotspot": over(
        "log_e",
        f"""SELECT {HOUR} AS hour, {DOW} AS day_of_week, count(*) AS n, {weekday_name(DOW)} AS weekday
            FROM log_e GROUP BY 1, 2, 4 ORDER BY n DESC, hour, day_of_week LIMIT 1""",
    ),
    "date_hour_matrix": over(
        "log_e",
        "SELECT strftime(ts, '%m-%d') AS date_label, count(*) AS total, "
        + ", ".join(CELLS.values())
        + " FROM log_e GROUP BY 1 ORDER BY total DESC, date_label LIMIT 30",
    ),
    "date_hour_hotspot": over(
        "log_e",
        f"""SELECT date_label, {HOUR} AS hour, count(*) AS n FROM (SELECT ts, strftime(ts, '%m-%d') AS date_label FROM log_e) x
            WHERE date_label IN (SELECT strftime(ts, '%m-%d') AS l FROM log_e GROUP BY 1
                                 ORDER BY count(*) DESC, l LIMIT 30)
            GROUP BY 1, 2 ORDER BY n DESC, date_label, hour LIMIT 1""",
    ),
    "gender_age_crosstab": over(
        "users",
        f"SELECT {GENDER} AS gender, user_age, {AGE} AS age, n FROM cells",
        AGE_CELLS,
    ),
    "gender_age_percent": over(
        "users",
        f"""SELECT {GENDER} AS gender, user_age, {AGE} AS age,
                   round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY user_gender), 6) AS percent
            FROM cells""",
        AGE_CELLS,
    ),
    "user_item_pivot": over(
        "log_l",
        """SELECT inviter_id, item_idx, count(*) AS n FROM log_l JOIN (
             SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS item_idx
             FROM (SELECT DISTINCT item_id FROM log_l) x) y USING (item_id) GROUP BY 1, 2""",
    ),
    # --- distributions
    "kde_by_group": kde_groups("user_gender"),
    "kde_by_group_limited": kde_groups("user_gender", "invite_count <= 60"),
    "kde_by_level": kde_groups("user_level"),
    # --- windows
    "daily_trend_ma7": over(
        "log_e",
        """SELECT "date", n, round(CASE WHEN row_number() OVER w >= 7 THEN
             avg(n) OVER (ORDER BY "date" ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) END, 6) AS moving_avg
           FROM (SELECT CAST(ts AS DATE) AS "date", count(*) AS n FROM log_e GROUP BY 1) x
           WINDOW w AS (ORDER BY "date")""",
    ),
    "daily_extremes": over(
        "log_e",
        """SELECT (SELECT d FROM c ORDER BY n DESC, d LIMIT 1) AS max_date, (SELECT max(n) FROM c) AS max_n,
                  (SELECT d FROM c ORDER BY n, d LIMIT 1) AS min_date, (SELECT min(n) FROM c) AS min_n""",
        "c AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM log_e GROUP BY 1)",
    ),
    "share_intervals": over(
        "intervals",
        """SELECT inviter_id, ts_micros, round(interval_hours, 6) AS interval_hours, count(*) AS n
           FROM intervals GROUP BY 1, 2, 3""",
    ),
    "topk_voters_per_inviter": over(
        "log_e",
        """SELECT inviter_id, voter_id, interaction_count, CAST(rank AS INTEGER) AS rank FROM (
             SELECT inviter_id, voter_id, count(*) AS interaction_count,
                    row_number() OVER (PARTITION BY inviter_id ORDER BY count(*) DESC, voter_id) AS rank
             FROM log_e GROUP BY 1, 2) x WHERE rank <= 5""",
    ),
    # --- graph and similarity
    "graph_edges": over("edges", "SELECT * FROM edges"),
    "degree_stats": over(
        "degrees",
        """SELECT 'in_degree' AS measure, round(avg(in_degree), 6) AS mean,
                  round(median(in_degree::DOUBLE), 6) AS median, max(in_degree) AS max FROM degrees
           UNION ALL SELECT 'out_degree', round(avg(out_degree), 6), round(median(out_degree::DOUBLE), 6),
                  max(out_degree) FROM degrees""",
    ),
    "node_roles": over(
        "degrees",
        """SELECT user_id, in_degree + out_degree AS total_degree,
                  CASE WHEN in_degree > out_degree THEN 'receiver' ELSE 'sender' END AS role,
                  round(least(1.0::DOUBLE, greatest(in_degree, out_degree) / (in_degree + out_degree + 0.1::DOUBLE)), 6)
                    AS strength,
                  round(greatest(20.0::DOUBLE, ln(1 + in_degree + out_degree) * 30), 6) AS weight FROM degrees""",
    ),
    "graph_hubs": over(
        "degrees",
        """SELECT *, in_degree + out_degree AS total_degree FROM degrees
           ORDER BY total_degree DESC, user_id LIMIT 10""",
    ),
    "graph_size": over(
        "edges degrees",
        "SELECT (SELECT count(*) FROM degrees) AS nodes, (SELECT count(*) FROM edges) AS edges",
    ),
    "bipartite_degrees": over(
        "log_e",
        """SELECT side, node_id, degree, round(weight, 6) AS weight,
                  row_number() OVER (PARTITION BY side ORDER BY degree DESC, node_id) <= 5 AS is_top
           FROM (SELECT 'inviter' AS side, inviter_id AS node_id, count(DISTINCT item_id) AS degree,
                        greatest(30.0::DOUBLE, ln(1 + count(DISTINCT item_id)) * 20) AS weight FROM log_e GROUP BY 2
                 UNION ALL
                 SELECT 'item', item_id, count(DISTINCT inviter_id),
                        greatest(20.0::DOUBLE, ln(1 + count(DISTINCT inviter_id)) * 15) FROM log_e GROUP BY 2) x""",
    ),
    "bipartite_size": over(
        "log_e",
        """SELECT count(DISTINCT inviter_id) AS inviters, count(DISTINCT item_id) AS items,
                  count(*) AS connections FROM log_e""",
    ),
    "user_similarity": over("cosines", "SELECT user_a, user_b, round(weight, 6) AS weight FROM cosines"),
    "similarity_degrees": over(
        "cosines",
        """SELECT inviter_id AS user_id,
                  (SELECT count(*) FROM cosines WHERE user_a = inviter_id OR user_b = inviter_id) AS degree
           FROM norms""",
    ),
    "log_count_matrix": over("matrix", "SELECT inviter_id, item_id, round(log_count, 6) AS log_count FROM matrix"),
    "user_distance_pairs": over(
        "matrix",
        """SELECT a.inviter_id AS user_a, b.inviter_id AS user_b,
                  round(sqrt(sum(pow(a.log_count - b.log_count, 2))), 6) AS distance
           FROM matrix a JOIN matrix b ON a.item_id = b.item_id AND a.inviter_id < b.inviter_id GROUP BY 1, 2""",
    ),
    "user_cluster_tree": cluster_tree("inviter_id", "item_id"),
    "item_cluster_tree": cluster_tree("item_id", "inviter_id"),
    "clustered_matrix": recursive(over(
        "matrix",
        """SELECT inviter_id, item_id, round(log_count, 6) AS log_count, u.place AS user_place, i.place AS item_place
           FROM matrix JOIN u_leaves u ON u.member = inviter_id JOIN i_leaves i ON i.member = item_id
           WHERE u.step = (SELECT max(step) FROM u_leaves) AND i.step = (SELECT max(step) FROM i_leaves)""",
        merges_ctes("u", "inviter_id", "item_id") + ", " + merges_ctes("i", "item_id", "inviter_id"),
    )),
    "betweenness": over(
        "degrees", "SELECT user_id, round(betweenness, 6) AS betweenness FROM central", betweenness_ctes(1000)
    ),
    "network_features": over(
        "degrees",
        """SELECT user_id, in_degree, out_degree, round(betweenness, 6) AS betweenness
           FROM degrees LEFT JOIN central USING (user_id)""",
        betweenness_ctes(1000),
    ),
    # --- sampling and splits
    "sample_n": over(
        "log_e",
        """SELECT inviter_id, item_id, voter_id, event_id FROM log_e
           ORDER BY md5('42|' || event_id), event_id LIMIT 1000""",
    ),
    "sample_nodes_subgraph": over(
        "degrees",
        "SELECT * FROM edges WHERE src IN (FROM nodes) AND dst IN (FROM nodes)",
        "nodes AS (SELECT user_id FROM degrees ORDER BY md5('42|' || user_id), user_id LIMIT 100)",
    ),
    "sample_rate": over(
        "log_e",
        f"SELECT inviter_id, item_id, voter_id, event_id FROM log_e WHERE {fraction('event_id')} < 0.3",
    ),
    "train_val_test_split": over(
        "log_e",
        f"""SELECT event_id, CASE WHEN f < 0.2::DOUBLE THEN 'test' WHEN f < 0.2::DOUBLE + 0.1::DOUBLE THEN 'val'
                   ELSE 'train' END AS split
            FROM (SELECT event_id, {fraction('event_id')} AS f FROM log_e) x""",
    ),
    # --- recommendation and evaluation
    "history_candidates": over("history", "SELECT triple_id, candidate_voter_list FROM history"),
    "pad_candidates": over(
        "history users",
        """SELECT triple_id, array_to_string(list_slice(list_concat(l, list_filter(pool.p, lambda x: NOT list_contains(l, x))), 1, 8), ',')
                    AS candidate_voter_list
           FROM (SELECT triple_id, CASE WHEN candidate_voter_list = '' THEN []::VARCHAR[]
                        ELSE string_split(candidate_voter_list, ',') END AS l FROM history) h, pool""",
        """pool AS (SELECT list(u ORDER BY h, u) AS p FROM (
             SELECT CAST(user_id AS VARCHAR) AS u, md5('42|' || user_id) AS h FROM users
             ORDER BY h, u LIMIT 8) x)""",
    ),
    "node_index": over(
        "log_e",
        """SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS idx
           FROM (SELECT inviter_id AS user_id FROM log_e UNION SELECT voter_id FROM log_e) x""",
    ),
    "score_all_candidates": over(
        "scored",
        "SELECT triple_id, CAST(rank AS INTEGER) AS rank, voter_id, round(score, 6) AS score FROM scored",
    ),
    "pair_features": over(
        "scored",
        """SELECT triple_id, s.inviter_id, s.item_id, s.voter_id,
             (SELECT count(*) FROM train t WHERE t.inviter_id = s.inviter_id AND t.voter_id = s.voter_id) AS pair_count,
             (SELECT count(*) FROM train t WHERE t.item_id = s.item_id AND t.voter_id = s.voter_id)
               AS item_voter_count,
             (SELECT count(*) FROM train t WHERE t.voter_id = s.voter_id) AS voter_popularity,
             (SELECT count(*) FROM train t WHERE t.inviter_id = s.inviter_id) AS inviter_activity,
             (SELECT count(*) FROM train t WHERE t.item_id = s.item_id) AS item_popularity,
             a.user_gender AS inviter_gender, a.user_age AS inviter_age, a.user_level AS inviter_level,
             b.user_gender AS voter_gender, b.user_age AS voter_age, b.user_level AS voter_level
           FROM scored s LEFT JOIN users a ON a.user_id = s.inviter_id LEFT JOIN users b ON b.user_id = s.voter_id""",
    ),
    "mrr_at_k": over(
        "history_rank",
        """SELECT round(avg(CASE WHEN place > 0 THEN 1.0::DOUBLE / place ELSE 0 END), 6) AS mrr,
                  count(*) AS queries FROM history_rank""",
    ),
    "hits_at_k": over(
        "history_rank",
        """SELECT round(avg(CASE WHEN place > 0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS hits,
                  count(*) AS queries FROM history_rank""",
    ),
}
ORACLE_SQL["write_stats_json"] = ORACLE_SQL["dataset_stats"]
ORACLE_SQL["user_item_embeddings"] = over("log_e", embedding_rows(), embedding_ctes("log_e"))
ORACLE_SQL["recommend_by_embedding"] = over("train queries", embedding_ranking(), embedding_ctes("train"))
ORACLE_SQL["train_ranker"] = trained_ranking("2024-01-19 00:00:00")

for _part in ("gender", "age", "level"):
    ORACLE_SQL[f"box_by_{_part}"] = box("invites_u", "invites_u", f"user_{_part}", "invite_count")
    ORACLE_SQL[f"box_by_{_part}_limited"] = box(
        "invites_u", "invites_u", f"user_{_part}", "invite_count", "invite_count <= 60"
    )

for _what, _view, _column, _bins in (
    ("invites", "invites", "invite_count", 50),
    ("votes", "votes", "voted_count", 50),
    ("in_degree", "degrees", "in_degree", 30),
    ("out_degree", "degrees", "out_degree", 30),
):
    _plain = f"SELECT {_column} AS x FROM {_view}"
    _logs = f"SELECT ln(1 + {_column}) AS x FROM {_view} WHERE {_column} > 0"
    ORACLE_SQL[f"hist_{_what}"] = hist(_view, _plain, _bins)
    ORACLE_SQL[f"hist_{_what}_log"] = hist(_view, _logs, _bins)
    ORACLE_SQL["kde_curve" if _what == "invites" else f"kde_{_what}"] = kde(_view, _plain)
    ORACLE_SQL[f"kde_{_what}_log"] = kde(_view, _logs)

_near = "SELECT interval_hours AS x FROM intervals WHERE interval_hours <= 24"
_all = "SELECT ln(1 + interval_hours) AS x FROM intervals"
ORACLE_SQL["hist_intervals"] = hist("intervals", _near, 50)
ORACLE_SQL["hist_intervals_log"] = hist("intervals", _all, 50)
ORACLE_SQL["kde_intervals"] = kde("intervals", _near)
ORACLE_SQL["kde_intervals_log"] = kde("intervals", _all)
