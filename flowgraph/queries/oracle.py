"""The queries of the registry as SQL over the same tables, for checking the results."""

from __future__ import annotations

from flowgraph.operators.panel import shuffle_constants
from flowgraph.plans.driver_tables import H
from flowgraph.queries import weights as W

ORACLE: dict[str, str] = {}

LAGS = [f"x_{k}" for k in range(1, H + 1)]

# The hour of an event, counted from the start of the first day.
FIRST_DAY = "(select date_trunc('day', min(ts)) as day0 from events) first_day"
STEP = "cast(floor((epoch_us(ts) - epoch_us(day0)) / 36e8) as bigint)"

# Named table expressions, each with the names it builds on.
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "nodes": ((), "select distinct user_id as node_id from events"),
    "edge_list": (
        (),
        """select src, dst, avg(gap) as cost, count(*) as n from (
             select lag(user_id) over w as src, user_id as dst, 1e0 + (epoch_us(ts) - epoch_us(lag(ts) over w)) / 6e7 as gap
             from events where event_type = 'purchase'
             window w as (partition by date_trunc('day', ts) order by ts, event_id)) x
           where src is not null and src <> dst group by src, dst""",
    ),
    "recurring": (("edge_list",), "select * from edge_list where n >= 2"),
    "readings": (
        (),
        f"""select user_id as node_id, {STEP} as t, event_type, value
           from events, {FIRST_DAY}""",
    ),
    "panel": (
        ("nodes", "readings"),
        """select n.node_id, g.t, cast(coalesce(c.flow, 0) as double) as flow
           from nodes n cross join (select unnest(range(0, steps)) as t from
             (select cast(24 * (date_diff('day', min(ts), max(ts)) + 1) as bigint) as steps from events) s) g
           left join (select node_id, t, count(*) as flow from readings group by 1, 2) c
             on c.node_id = n.node_id and c.t = g.t""",
    ),
    "features": (
        ("readings",),
        """select node_id, t, cast(count(*) as double) as flow,
                  avg(case when event_type = 'purchase' then 1e0 else 0e0 end) as occupy, avg(value) as speed
           from readings group by node_id, t""",
    ),
    "base": (("panel",), "select node_id, max(flow) as mx, min(flow) as mn from panel group by node_id"),
    "scaled": (
        ("panel", "base"),
        """select p.node_id, p.t, (p.flow - b.mn) / nullif(b.mx - b.mn, 0) as x
           from panel p join base b on p.node_id = b.node_id""",
    ),
    "shifted": (("panel",), "select node_id, t, flow + 1 as x from panel"),
}


def windows_of(source: str) -> str:
    lags = ", ".join(f"lag(x, {H + 1 - k}) over w as x_{k}" for k in range(1, H + 1))
    return f"""select * from (select node_id, t, x as y, {lags},
        avg(x) over (partition by node_id order by t rows between {H} preceding and 1 preceding) as m
        from {source} window w as (partition by node_id order by t)) z where t >= {H}"""


TABLES["win"] = (("scaled",), windows_of("scaled"))
TABLES["win_shifted"] = (("shifted",), windows_of("shifted"))

for _name, _edges in (("", "edge_list"), ("_recurring", "recurring")):
    TABLES[f"adj{_name}"] = (
        (_edges,),
        f"select distinct i, j, 1e0 as w from (select src as i, dst as j from {_edges} union all select dst, src from {_edges}) z",
    )
    TABLES[f"loops{_name}"] = (
        (f"adj{_name}", "nodes"),
        f"""select i, j, sum(w) as w from (select i, j, w from adj{_name}
            union all select node_id, node_id, 1e0 from nodes) z group by i, j""",
    )
    TABLES[f"walk{_name}"] = (
        (f"loops{_name}",),
        f"""select a.i, a.j, a.w / d.d as w from loops{_name} a
            join (select i, sum(w) as d from loops{_name} group by i) d on a.i = d.i""",
    )
    TABLES[f"rowsum{_name}"] = (
        (f"adj{_name}", "nodes"),
        f"""select n.node_id, coalesce(sum(a.w), 0e0) as d from nodes n left join adj{_name} a on a.i = n.node_id
            group by n.node_id""",
    )
    TABLES[f"lap{_name}"] = (
        (f"adj{_name}", f"rowsum{_name}"),
        f"""select a.i, a.j, -a.w / sqrt(p.d) / sqrt(q.d) as w from adj{_name} a
              join rowsum{_name} p on a.i = p.node_id join rowsum{_name} q on a.j = q.node_id
            union all select node_id, node_id, 1e0 from rowsum{_name}""",
    )
    TABLES[f"lap_plain{_name}"] = (
        (f"adj{_name}", f"rowsum{_name}"),
        f"select i, j, -w as w from adj{_name} union all select node_id, node_id, d from rowsum{_name}",
    )

TABLES["adj_distance"] = (
    ("edge_list",),
    """select i, j, 1 / min(cost) as w from (select src as i, dst as j, cost from edge_list
       union all select dst, src, cost from edge_list) z group by i, j""",
)
TABLES["degree"] = (
    ("edge_list",),
    "select id, count(*) as d from (select src as id from edge_list union all select dst from edge_list) z group by id",
)
TABLES["directed"] = (
    ("edge_list", "degree"),
    """select e.dst as i, e.src as j, 1 / sqrt(cast(s.d as double) * t.d) as w
       from edge_list e join degree s on e.src = s.id join degree t on e.dst = t.id""",
)
TABLES["arrived"] = (
    ("directed", "win"),
    """select w.i as node_id, s.t, sum(w.w * s.m) as p from directed w join win s on s.node_id = w.j group by w.i, s.t""",
)
TABLES["fc_scaled"] = (
    ("win", "arrived"),
    """select s.node_id, s.t, coalesce(a.p, s.m) as prediction, s.y as target
       from win s left join arrived a on a.node_id = s.node_id and a.t = s.t""",
)


def restored(source: str) -> str:
    return f"""select f.node_id, f.t, f.prediction * (b.mx - b.mn) + b.mn as prediction, f.target * (b.mx - b.mn) + b.mn as target
        from {source} f join base b on b.node_id = f.node_id where f.t >= 480 and f.t < 720"""


TABLES["fc"] = (("fc_scaled", "base"), restored("fc_scaled"))
TABLES["fc_mean"] = (
    ("win", "base"),
    restored("(select node_id, t, m as prediction, y as target from win)"),
)
TABLES["averages"] = (("panel",), "select node_id, avg(flow) as x from panel group by node_id")


# --- network layers ------------------------------------------------------------------------------------------

def linear(columns: list[str], weight: list[list[float]], bias: list[float] | None, names: list[str]) -> str:
    outputs = []
    for c, name in enumerate(names):
        terms = [f"{x} * cast({weight[r][c]!r} as double)" for r, x in enumerate(columns)]
        if bias is not None:
            terms.append(f"cast({bias[c]!r} as double)")
        outputs.append(f"{' + '.join(terms)} as {name}")
    return ", ".join(outputs)


def sums(names: list[str], act: str = "{}") -> str:
    return ", ".join(act.format(f"sum(w.w * z.{n})") + f" as {n}" for n in names)


HIDDEN = [f"h_{c}" for c in range(1, W.HIDDEN + 1)]
# greatest() would turn a null into 0.
RELU = "case when {0} > 0 then {0} when {0} is not null then 0e0 end"

_gcn, _cheb, _gat = W.gcn(), W.cheb(), W.gat()

TABLES["gcn_z1"] = (("win",), f"select node_id, t, {linear(LAGS, _gcn.weight[0], _gcn.bias[0], HIDDEN)} from win")
TABLES["gcn_h1"] = (
    ("gcn_z1", "walk"),
    f"select w.i as node_id, z.t, {sums(HIDDEN, RELU)} from walk w join gcn_z1 z on z.node_id = w.j group by w.i, z.t",
)
TABLES["gcn_z2"] = (("gcn_h1",), f"select node_id, t, {linear(HIDDEN, _gcn.weight[1], _gcn.bias[1], ['p'])} from gcn_h1")
TABLES["gcn_out"] = (
    ("gcn_z2", "walk"),
    f"select w.i as node_id, z.t, {sums(['p'], RELU)} from walk w join gcn_z2 z on z.node_id = w.j group by w.i, z.t",
)


def cheb_layer(source: str, columns: list[str], layer: int, names: list[str]) -> str:
    """Builds the tables of one filter layer on `source` and returns the name of the last one."""
    first = f"{source}_l"
    TABLES[first] = (
        (source, "lap"),
        f"select w.i as node_id, z.t, {sums(columns)} from lap w join {source} z on z.node_id = w.j group by w.i, z.t",
    )
    second = f"{source}_ll"
    TABLES[second] = (
        (first, "lap"),
        f"select w.i as node_id, z.t, {sums(columns)} from lap w join {first} z on z.node_id = w.j group by w.i, z.t",
    )
    taps = [f"a.{c}" for c in columns] + [f"b.{c}" for c in columns] + [f"(2 * c.{c} - a.{c})" for c in columns]
    stacked = [row for tap in _cheb.weight[layer] for row in tap]
    outputs = []
    for k, name in enumerate(names):
        value = linear(taps, [[row[k]] for row in stacked], [_cheb.bias[layer][k]], ["v"]).removesuffix(" as v")
        outputs.append(f"{RELU.format(f'({value})')} as {name}")
    out = f"{source}_out"
    TABLES[out] = (
        (source, first, second),
        f"""select a.node_id, a.t, {', '.join(outputs)} from {source} a
            join {first} b on a.node_id = b.node_id and a.t = b.t join {second} c on a.node_id = c.node_id and a.t = c.t""",
    )
    return out


TABLES["cheb_x"] = (("win",), f"select node_id, t, {', '.join(LAGS)} from win")
CHEB_OUT = cheb_layer(cheb_layer("cheb_x", LAGS, 0, HIDDEN), HIDDEN, 1, ["p"])


def head(a: int) -> list[str]:
    return [f"g_{a}_{c}" for c in range(1, W.HIDDEN + 1)]


ALL_HEADS = [c for a in range(1, W.HEADS + 1) for c in head(a)]
STACKED = [[v for h in _gat.heads for v in h[r]] for r in range(H)]


def leaky(x: str) -> str:
    return f"case when {x} >= 0 then {x} else 0.01e0 * ({x}) end"


def attention(name: str, h: str, adj: str, heads: list[list[str]], bias: list[list[float]]) -> str:
    """Tables <name>_s (scores), <name>_a (weights of live pairs) and <name> (output with leaky relu)."""
    scores = ", ".join(
        "nullif((" + " + ".join(f"p.{c} * q.{c}" for c in columns) + f") * w.w, 0e0) as s_{a}"
        for a, columns in enumerate(heads, 1)
    )
    carried = ", ".join(f"q.{c}" for columns in heads for c in columns)
    TABLES[f"{name}_s"] = (
        (h, adj),
        f"""select w.i, w.j, p.t, {scores}, {carried} from {adj} w
            join {h} p on p.node_id = w.i join {h} q on q.node_id = w.j and q.t = p.t""",
    )
    tops = ", ".join(f"max(s_{a}) as top_{a}" for a in range(1, len(heads) + 1))
    TABLES[f"{name}_m"] = ((f"{name}_s",), f"select i, t, {tops} from {name}_s group by i, t")
    tops = ", ".join(f"exp(s.s_{a} - m.top_{a}) as e_{a}" for a in range(1, len(heads) + 1))
    TABLES[f"{name}_e"] = (
        (f"{name}_s", f"{name}_m"),
        f"select s.*, {tops} from {name}_s s join {name}_m m on s.i = m.i and s.t = m.t",
    )
    gathered = ", ".join(
        [f"sum(e_{a}) as z_{a}" for a in range(1, len(heads) + 1)]
        + [f"sum(e_{a} * {c}) as {c}" for a, columns in enumerate(heads, 1) for c in columns]
    )
    TABLES[f"{name}_g"] = ((f"{name}_e",), f"select i, t, {gathered} from {name}_e group by i, t")
    everyone = ", ".join(f"avg({c}) as {c}" for columns in heads for c in columns)
    TABLES[f"{name}_u"] = ((h,), f"select t, {everyone} from {h} group by t")
    raw = ", ".join(
        f"coalesce(g.{c} / g.z_{a}, u.{c}) + cast({b!r} as double) as {c}"
        for a, (columns, shift) in enumerate(zip(heads, bias), 1)
        for c, b in zip(columns, shift)
    )
    TABLES[f"{name}_o"] = (
        (h, f"{name}_g", f"{name}_u"),
        f"""select n.node_id, n.t, {raw} from {h} n join {name}_u u on u.t = n.t
            left join {name}_g g on g.i = n.node_id and g.t = n.t""",
    )
    flat = [c for columns in heads for c in columns]
    TABLES[name] = ((f"{name}_o",), f"select node_id, t, {', '.join(f'{leaky(c)} as {c}' for c in flat)} from {name}_o")
    return name


def gat_tables(prefix: str, source: str, adj: str) -> str:
    heads = [head(a) for a in range(1, W.HEADS + 1)]
    TABLES[f"{prefix}_h"] = ((source,), f"select node_id, t, {linear(LAGS, STACKED, None, ALL_HEADS)} from {source}")
    first = attention(f"{prefix}_1", f"{prefix}_h", adj, heads, _gat.head_bias)
    TABLES[f"{prefix}_h2"] = ((first,), f"select node_id, t, {linear(ALL_HEADS, _gat.out, None, ['p'])} from {first}")
    return attention(f"{prefix}_2", f"{prefix}_h2", adj, [["p"]], [_gat.out_bias])


GAT_OUT = gat_tables("gat", "win", "adj")
GAT_SHIFTED = gat_tables("gats", "win_shifted", "adj_recurring")
gat_tables("gatd", "win", "adj_distance")


# --- assembling ----------------------------------------------------------------------------------------------

def needed(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            needed(TABLES[name][0], seen)
            seen.append(name)
    return seen


def sql(body: str, *tables: str, recursive: str = "") -> str:
    # Attention pairs are too many to be kept; all other tables are built once.
    kept = {name: "" if name.startswith("gat") else "materialized " for name in TABLES}
    parts = [f"{name} as {kept[name]}(\n{TABLES[name][1]})" for name in needed(tables, [])]
    if recursive:
        parts.append(recursive)
    if not parts:
        return body
    return ("with recursive " if recursive else "with ") + ",\n".join(parts) + "\n" + body


def r6(expression: str, name: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0e0 as {name}"


def add(name: str, body: str, *tables: str, recursive: str = "") -> None:
    ORACLE[name] = sql(body, *tables, recursive=recursive)


add("edge_projection", f"select src, dst, {r6('cost', 'weight')} from edge_list", "edge_list")
add("edge_csv_source", f"select src, dst, {r6('cost', 'weight')} from edge_list", "edge_list")
_bad = [("malformed", "src || ',' || dst"), ("malformed", "src || ',x,' || n"), ("malformed", "src || ',' || dst || ',' || n || ',9'"),
        ("not_finite", "src || ',' || dst || ',NaN'"), ("missing", "src || ',,' || n || '.0'"), ("not_finite", "src || ',' || dst || ',Infinity'")]
add(
    "edge_csv_rejects",
    "select src, dst, n::double as weight, 'good' as reason, null::varchar as row from edge_list"
    " union all select src, dst, n + 5e-1, 'good', null from edge_list"
    + "".join(f" union all select null, null, null, '{reason}', {row} from edge_list" for reason, row in _bad),
    "edge_list",
)
add("node_set", "select src as node_id from edge_list union select dst from edge_list", "edge_list")
add(
    "id_remap",
    f"""select s.idx as src, d.idx as dst, {r6('e.cost', 'weight')} from edge_list e
        join (select node_id, row_number() over (order by node_id) - 1 as idx from nodes) s on s.node_id = e.src
        join (select node_id, row_number() over (order by node_id) - 1 as idx from nodes) d on d.node_id = e.dst""",
    "edge_list", "nodes",
)
add(
    "unknown_ids",
    """select node_id from (select src as node_id from edge_list union select dst from edge_list) z
       where node_id not in (select src from recurring) and node_id not in (select dst from recurring)""",
    "recurring",
)
add("adjacency_connect", "select i, j, w from adj", "adj")
add("adjacency_distance", f"select i, j, {r6('w', 'w')} from adj_distance", "adj_distance")
add(
    "degree_total",
    """select n.node_id, coalesce(d.d, 0) as degree,
              case when d.d > 0 then round(1 / sqrt(cast(d.d as double)), 6) else 0e0 end as inv_sqrt_degree
       from nodes n left join (select id, count(*) as d from (select src as id from recurring
         union all select dst from recurring) z group by id) d on d.id = n.node_id""",
    "nodes", "recurring",
)
add(
    "degree_in",
    """select n.node_id, coalesce(d.d, 0) as degree,
              case when d.d > 0 then round(1 / sqrt(cast(d.d as double)), 6) else 0e0 end as inv_sqrt_degree
       from nodes n left join (select dst, count(*) as d from edge_list group by dst) d on d.dst = n.node_id""",
    "nodes", "edge_list",
)
add(
    "degree_weighted",
    f"""select i, {r6('sum(w)', 'd')} from (select i, j, w from adj_distance
        union all select node_id, node_id, 1e0 from nodes) z group by i""",
    "adj_distance", "nodes",
)
add(
    "degree_stats",
    f"""select count(*) as count, {r6('avg(d)', 'mean')}, {r6('stddev_samp(d)', 'stddev')},
        min(d) as min, max(d) as max from degree""",
    "degree",
)
add(
    "graph_counts",
    "select (select count(*) from nodes) as vertices, (select count(*) from edge_list) as edges",
    "nodes", "edge_list",
)
for _s in ("", "_recurring"):
    for _query, _table in (("self_loops", "loops"), ("random_walk", "walk"), ("laplacian_norm", "lap"), ("laplacian_unnorm", "lap_plain")):
        add(f"{_query}{_s}", f"select i, j, {r6('sum(w)', 'w')} from {_table}{_s} group by i, j", f"{_table}{_s}")
    REACH = f"""reach as (select node_id as a, node_id as b from nodes
        union select r.a, e.j from reach r join adj{_s} e on e.i = r.b)"""
    add(
        f"components{_s}",
        "select a as node_id, min(b) as component from reach group by a",
        "nodes", f"adj{_s}", recursive=REACH,
    )
add(
    "component_count",
    "select count(distinct component) as components from (select min(b) as component from reach group by a) z",
    "nodes", "adj_recurring", recursive=REACH,
)

add("dense_panel", "select node_id, t, flow from panel", "panel")
add("node_average", f"select node_id, {r6('x', 'features')} from averages", "averages")
add(
    "node_average_join",
    f"select node_id, 'Sensor ' || cast(node_id as varchar) as description, {r6('x', 'features')} from averages",
    "averages",
)
add("minmax_base", "select node_id, mx as max_flow, mn as min_flow from base", "base")
add(
    "minmax_base_train",
    "select node_id, max(flow) as max_flow, min(flow) as min_flow from panel where t < 480 group by node_id",
    "panel",
)
add("minmax_scale", f"select node_id, t, {r6('x', 'flow')} from scaled", "scaled")
add(
    "minmax_inverse",
    f"select s.node_id, s.t, {r6('s.x * (b.mx - b.mn) + b.mn', 'flow')} from scaled s join base b on b.node_id = s.node_id",
    "scaled", "base",
)
add(
    "panel_shape",
    """select count(distinct node_id) as nodes, count(*) as cells, count(distinct t) as steps, min(t) as first_step,
       max(t) as last_step from panel""",
    "panel",
)
add("array_source", "select node_id, t, flow, flow + t * 10 as load from panel", "panel")
add(
    "array_source_span",
    """select node_id, t, flow + t * 10 as load from panel, (select max(t) + 1 as steps from panel) s
       where t >= steps - steps // 3""",
    "panel",
)
add("feature_select", f"select node_id, t, {r6('speed', 'flow')} from features", "features")
_bins = ", ".join(
    f"count(*) filter (least(floor((l.x - s.low) / (s.high - s.low) * 10), 9) = {b}) as bin_{b}" for b in range(10)
)
add(
    "feature_profile",
    f"""select l.feature, count(*) as n, {r6('avg(l.x)', 'mean')}, {r6('stddev_samp(l.x)', 'stddev')},
        {r6('min(l.x)', 'low')}, {r6('max(l.x)', 'high')}, {r6('stddev_samp(l.x) / avg(l.x)', 'variation')}, {_bins}
        from long l join (select feature, min(x) as low, max(x) as high from long group by feature) s
          on s.feature = l.feature group by l.feature""",
    "features",
)
ORACLE["feature_profile"] = ORACLE["feature_profile"].replace(
    "\nselect l.feature",
    """,
long as (select 'flow' as feature, flow as x from features union all select 'occupy', occupy from features
  union all select 'speed', speed from features)
select l.feature""",
    1,
)
_lags = ", ".join(r6(c, c) for c in LAGS)
add("history_windows", f"select node_id, t, {r6('y', 'y')}, {_lags} from win", "win")
add("history_mean", f"select node_id, t, {r6('y', 'y')}, {r6('m', 'hist_mean')} from win", "win")
_gaps = ", ".join(
    f"max(flow) over (partition by node_id order by t range between {H + 1 - k} preceding and {H + 1 - k} preceding) as x_{k}"
    for k in range(1, H + 1)
)
_range = f"over (partition by node_id order by t range between {H} preceding and 1 preceding)"
add(
    "history_windows_gappy",
    f"""select node_id, t, flow as y, count(*) {_range} = {H} as complete, {_gaps},
        {r6(f'avg(flow) {_range}', 'hist_mean')} from features""",
    "features",
)
add(
    "incomplete_windows",
    f"select count(*) filter (t < {H}) as dropped, count(*) filter (t >= {H}) as kept from panel",
    "panel",
)


def split_counts(train: tuple[int | str, int | str], test: tuple[int | str, int | str]) -> str:
    return f"""select split, count(distinct t) as samples, count(*) as cells, min(t) as first_step, max(t) as last_step
        from (select t, case when t >= {train[0]} and t < {train[1]} then 'train'
                             when t >= {test[0]} and t < {test[1]} then 'test' end as split from win) z
        where split is not null group by split"""


add("split_counts", split_counts((6, 480), (480, 720)), "win")
_end = "(select 486 + greatest(0, least(240, max(t) + 1 - 6 - 1 - 480)) from panel)"
add("split_clamped", split_counts((6, 480), (486, _end)), "win")
add(
    "batch_sequential",
    """select (t - 480) // 64 as batch_id, count(*) as cells, min(t) as first_step, max(t) as last_step
       from win where t >= 480 and t < 720 group by 1""",
    "win",
)
_factor, _shift = shuffle_constants(474, 7, 1)
SHUFFLED = f"((t - 6) * {_factor} + {_shift}) % 474 // 64"
add(
    "batch_shuffled",
    f"""select {SHUFFLED} as batch_id, count(*) as cells, cast(sum(t) as bigint) as step_sum
        from win where t < 480 group by 1""",
    "win",
)
add(
    "series_arrays",
    """select node_id, t // 24 as block, string_agg(cast(t as varchar), ',' order by t) as steps,
       string_agg(cast(cast(flow as bigint) as varchar), ',' order by t) as flow from panel group by 1, 2""",
    "panel",
)
add("series_rows", "select node_id, t, flow from panel", "panel")

_band = """case when hour between 7 and 9 or hour between 17 and 19 then {} when hour between 22 and 23
    or hour between 0 and 5 then {} else {} end"""
add(
    "time_bands",
    f"""select hour, {_band.format("'peak'", "'night'", "'normal'")} as band, {_band.format('2e0', '0.5e0', '1e0')} as factor,
        count(*) as n, {r6('avg(value)', 'mean_value')}
        from (select cast(date_part('hour', ts) as bigint) as hour, value from events) z group by hour""",
)
add(
    "seasonal_factor",
    f"""select node_id, t, {r6(f"x * {_band.format('2e0', '0.5e0', '1e0')}", 'seasonal')}
        from (select p.node_id, p.t, p.t % 24 as hour, a.x from panel p join averages a on a.node_id = p.node_id) z""",
    "panel", "averages",
)
add(
    "step_timestamps",
    f"""select event_id, t, t % 24 as hour,
       strftime(day0 + to_hours(t), '%Y-%m-%d %H:%M:%S') as step_start, t as t_again
       from (select event_id, day0, {STEP} as t from events, {FIRST_DAY}) z""",
)

for _name, _fn in (("message_sum", "sum"), ("message_max", "max")):
    add(
        _name,
        f"""select e.dst as node_id, {r6(f'{_fn}(a.x)', 'message')} from edge_list e
            join averages a on a.node_id = e.src group by e.dst""",
        "edge_list", "averages",
    )


def rounds(edges: str, null_mode: str) -> str:
    gain = "r.m" if null_mode == "propagate" else "coalesce(r.m, 0e0)"
    levels = ["a0 as (select node_id, x from averages)"]
    for k in range(3):
        levels.append(
            f"""a{k + 1} as (select n.node_id, n.x + {gain} as x from a{k} n left join
                (select e.dst, sum(s.x) as m from {edges} e join a{k} s on s.node_id = e.src group by e.dst) r
                on r.dst = n.node_id)"""
        )
    return ", ".join(levels)


for _name, _edges, _mode in (
    ("additive_rounds_3", "edge_list", "propagate"),
    ("additive_rounds_3_recurring", "recurring", "propagate"),
    ("additive_rounds_3_zero", "recurring", "zero"),
):
    add(_name, f"select node_id, {r6('x', 'features')} from a3", _edges, "averages", recursive=rounds(_edges, _mode))

add("gcn_directed_all_snapshots", f"select node_id, t, {r6('p', 'gcn_output', 8)} from arrived", "arrived")
add(
    "spmm",
    f"select w.i as node_id, s.t, {r6('sum(w.w * s.x)', 'flow', 8)} from walk w join scaled s on s.node_id = w.j group by w.i, s.t",
    "walk", "scaled",
)
TABLES["hub_edges"] = (
    ("edge_list", "nodes"),
    """select src, dst from edge_list union select h.id, n.node_id from nodes n join
       (select user_id as id from events group by user_id order by count(*) desc, user_id limit 1) h on n.node_id <> h.id""",
)
add(
    "spmm_hub",
    f"select e.dst as node_id, s.t, {r6('sum(s.x)', 'flow', 8)} from hub_edges e join scaled s on s.node_id = e.src group by e.dst, s.t",
    "hub_edges", "scaled",
)
TABLES["t0"] = (("scaled",), "select node_id, t, x from scaled")
TABLES["t1"] = (
    ("t0", "lap"),
    "select w.i as node_id, s.t, sum(w.w * s.x) as x from lap w join t0 s on s.node_id = w.j group by w.i, s.t",
)
for _k in (2, 3):
    TABLES[f"t{_k}"] = (
        (f"t{_k - 1}", f"t{_k - 2}", "lap"),
        f"""select a.node_id, a.t, 2 * a.x - b.x as x from (select w.i as node_id, s.t, sum(w.w * s.x) as x
            from lap w join t{_k - 1} s on s.node_id = w.j group by w.i, s.t) a
            join t{_k - 2} b on a.node_id = b.node_id and a.t = b.t""",
    )
add(
    "cheb_basis",
    f"""select a.node_id, a.t, {', '.join(r6(f'{n}.x', f'flow_k{k}') for k, n in enumerate('abcd'))} from t0 a
        join t1 b on a.node_id = b.node_id and a.t = b.t join t2 c on a.node_id = c.node_id and a.t = c.t
        join t3 d on a.node_id = d.node_id and a.t = d.t""",
    "t3",
)

for _name, _table, _win in (
    ("gcn_layers", "gcn_out", "win"),
    ("cheb_layers", CHEB_OUT, "win"),
    ("gcn_score", "gcn_out", "win"),
    ("cheb_score", CHEB_OUT, "win"),
    ("gat_score", GAT_OUT, "win"),
    ("gat_score_shifted", GAT_SHIFTED, "win_shifted"),
):
    add(
        _name,
        f"""select o.node_id, o.t, {r6('o.p', 'prediction')}, {r6('w.y', 'target')} from {_table} o
            join {_win} w on w.node_id = o.node_id and w.t = o.t""",
        _table, _win,
    )
add(
    "gat_scores",
    f"""select i, j, count(s_1) as live_1, {r6('sum(s_1)', 's_1')}, count(s_2) as live_2, {r6('sum(s_2)', 's_2')}
        from gatd_1_s group by i, j having count(s_1) > 0 or count(s_2) > 0""",
    "gatd_1_s",
)
add(
    "gat_softmax",
    f"""select e.i, e.j, {r6('sum(e.e_1 / g.z_1)', 'alpha_1')}, {r6('sum(e.e_2 / g.z_2)', 'alpha_2')}
        from gatd_1_e e join gatd_1_g g on g.i = e.i and g.t = e.t group by e.i, e.j
        having count(e.e_1) > 0 or count(e.e_2) > 0""",
    "gatd_1_e", "gatd_1_g",
)

ERRORS = ", ".join(
    [
        "count(target - prediction) as n",
        "count(*) - count(target - prediction) as skipped",
        r6("avg(abs(target - prediction))", "mae"),
        r6("avg(abs(target - prediction) / (target + 5))", "mape"),
        r6("sqrt(avg((target - prediction) * (target - prediction)))", "rmse"),
    ]
)
add("neighbour_forecast", f"select node_id, t, {r6('prediction', 'prediction')}, {r6('target', 'target')} from fc", "fc")
add("forecast_metrics", f"select {ERRORS} from fc", "fc")
add("mean_forecast_metrics", f"select {ERRORS} from fc_mean", "fc_mean")
TABLES["fc_gcn"] = (
    ("gcn_out", "win", "base"),
    restored("(select o.node_id, o.t, o.p as prediction, w.y as target from gcn_out o join win w on w.node_id = o.node_id and w.t = o.t)"),
)
add("model_metrics", f"select {ERRORS} from fc_gcn", "fc_gcn")
add("batch_metrics", f"select (t - 480) // 64 as batch_id, {ERRORS} from fc group by 1", "fc")
add(
    "mean_batch_metrics",
    f"""select count(*) as batches, {r6('avg(mae)', 'mae')}, {r6('avg(mape)', 'mape')}, {r6('avg(rmse)', 'rmse')}
        from (select avg(abs(target - prediction)) as mae, avg(abs(target - prediction) / (target + 5)) as mape,
                     sqrt(avg((target - prediction) * (target - prediction))) as rmse
              from fc group by (t - 480) // 64) z""",
    "fc",
)
SQUARED = "avg((target - prediction) * (target - prediction))"
add(
    "running_loss",
    f"""select batch_id, {r6('mse', 'mse', 8)}, {r6('sum(mse) over (order by batch_id) * 1000 / 240e0', 'loss', 8)}
        from (select (t - 480) // 64 as batch_id, {SQUARED} as mse from fc_scaled where t >= 480 and t < 720 group by 1) z""",
    "fc_scaled",
)
add(
    "epoch_loss",
    f"""select {r6('sum(mse) * 1000 / 474e0', 'loss', 8)} from
        (select {SHUFFLED} as batch_id, {SQUARED} as mse from fc_scaled where t < 480 group by 1) z""",
    "fc_scaled",
)
add("forecast_roundtrip", f"select node_id, t, {r6('prediction', 'prediction')}, {r6('target', 'target')} from fc", "fc")
add(
    "normalised_roundtrip",
    f"select node_id, t, {r6('prediction', 'prediction')}, {r6('target', 'target')} from fc_scaled where t >= 480 and t < 720",
    "fc_scaled",
)
add(
    "ordered_output",
    f"""select node_id, t, {r6('prediction', 'prediction')}, {r6('target', 'target')},
        row_number() over (order by node_id, t) - 1 as position from fc""",
    "fc",
)
_plot = "from fc where node_id = (select min(node_id) from nodes) and t >= 480 and t < 528"
add("plot_slice", f"select t - 480 as step, {r6('prediction', 'prediction')}, {r6('target', 'target')} {_plot}", "fc", "nodes")
add(
    "model_plot_slice",
    f"select t - 480 as step, {r6('prediction', 'prediction')}, {r6('target', 'target')} {_plot.replace('from fc', 'from fc_gcn')}",
    "fc_gcn", "nodes",
)
add(
    "plot_bounds",
    f"select {r6('min(least(prediction, target))', 'low')}, {r6('max(greatest(prediction, target))', 'high')} {_plot}",
    "fc", "nodes",
)
add(
    "first_k_samples",
    f"select node_id, t, {r6('prediction', 'prediction')} from fc where t in (select distinct t from fc order by t limit 5)",
    "fc",
)


# --- training ------------------------------------------------------------------------------------------------

def lagged(tables: list[str], columns: list[str]) -> str:
    """History columns of filtered series, tap by tap, with the target."""
    lags = []
    for table, column in zip(tables, columns):
        lags += [f"lag({table}.{column}, {H + 1 - k}) over w as {table}_{k}" for k in range(1, H + 1)]
    joins = " ".join(f"join {t} on {t}.node_id = s.node_id and {t}.t = s.t" for t in tables)
    return f"""select * from (select s.node_id, s.t, s.x as y, {', '.join(lags)} from scaled s {joins}
        window w as (partition by s.node_id order by s.t)) z where t >= 6 and t < 480"""


TABLES["p0"] = (
    ("walk", "scaled"),
    "select w.i as node_id, s.t, sum(w.w * s.x) as x from walk w join scaled s on s.node_id = w.j group by w.i, s.t",
)


def twice_filtered(name: str, source: str, columns: list[str]) -> None:
    """<name>_1 = L source, <name>_2 = 2 L <name>_1 - source."""
    TABLES[f"{name}_1"] = (
        (source, "lap"),
        f"select w.i as node_id, z.t, {sums(columns)} from lap w join {source} z on z.node_id = w.j group by w.i, z.t",
    )
    TABLES[f"{name}_2"] = (
        (f"{name}_1", source, "lap"),
        f"""select a.node_id, a.t, {', '.join(f'2 * a.{c} - b.{c} as {c}' for c in columns)}
            from (select w.i as node_id, z.t, {sums(columns)} from lap w join {name}_1 z on z.node_id = w.j group by w.i, z.t) a
            join {source} b on a.node_id = b.node_id and a.t = b.t""",
    )


def gradient_query(name: str, taps: list[str], first: list[list[float]], bias: list[float], second: list[list[float]], last: float) -> None:
    inputs = [f"{tap}_{k}" for tap in taps for k in range(1, H + 1)]
    TABLES[f"{name}_rows"] = (("scaled", *taps), lagged(taps, ["x"] * len(taps)))
    TABLES[f"{name}_h"] = (
        (f"{name}_rows",),
        "select r.*, " + ", ".join(
            RELU.format("(" + linear(inputs, [[row[c]] for row in first], [bias[c]], ["v"]).removesuffix(" as v") + ")") + f" as {h}"
            for c, h in enumerate(HIDDEN)
        ) + f" from {name}_rows r",
    )
    if len(second) == 1:
        z = linear(HIDDEN, [[w] for w in second[0]], None, ["z"])
        TABLES[f"{name}_z"] = ((f"{name}_h",), f"select node_id, t, {z} from {name}_h")
        TABLES[f"{name}_o"] = (
            (f"{name}_z", "walk"),
            f"select w.i as node_id, z.t, sum(w.w * z.z) as o from walk w join {name}_z z on z.node_id = w.j group by w.i, z.t",
        )
    else:
        TABLES[f"{name}_u"] = ((f"{name}_h",), f"select node_id, t, {', '.join(HIDDEN)} from {name}_h")
        twice_filtered(f"{name}_u", f"{name}_u", HIDDEN)
        o = " + ".join(
            linear([f"{a}.{c}" for c in HIDDEN], [[w] for w in second[k]], None, ["z"]).removesuffix(" as z")
            for k, a in enumerate("abc")
        )
        TABLES[f"{name}_o"] = (
            (f"{name}_u", f"{name}_u_1", f"{name}_u_2"),
            f"""select a.node_id, a.t, {o} as o from {name}_u a join {name}_u_1 b on a.node_id = b.node_id and a.t = b.t
                join {name}_u_2 c on a.node_id = c.node_id and a.t = c.t""",
        )
    level = f"(o.o + cast({last!r} as double))"
    TABLES[f"{name}_d"] = (
        (f"{name}_o", f"{name}_rows"),
        f"""select o.node_id, o.t, power({RELU.format(level)} - r.y, 2) as sq,
            case when {level} > 0 then 2 * ({level} - r.y) else 0e0 end as d
            from {name}_o o join {name}_rows r on r.node_id = o.node_id and r.t = o.t""",
    )
    if len(second) == 1:
        TABLES[f"{name}_v"] = (
            (f"{name}_d", "walk"),
            f"""select d.node_id, d.t, d.d, d.sq, v.v as v_0 from {name}_d d join (select w.j as node_id, z.t, sum(w.w * z.d) as v
                from walk w join {name}_d z on z.node_id = w.i group by w.j, z.t) v on v.node_id = d.node_id and v.t = d.t""",
        )
    else:
        twice_filtered(f"{name}_d", f"{name}_d", ["d"])
        TABLES[f"{name}_v"] = (
            (f"{name}_d", f"{name}_d_1", f"{name}_d_2"),
            f"""select a.node_id, a.t, a.d, a.sq, a.d as v_0, b.d as v_1, c.d as v_2 from {name}_d a
                join {name}_d_1 b on a.node_id = b.node_id and a.t = b.t join {name}_d_2 c on a.node_id = c.node_id and a.t = c.t""",
        )
    errors = ", ".join(
        f"case when h.{h} > 0 then "
        + " + ".join(f"v.v_{k} * cast({tap[c]!r} as double)" for k, tap in enumerate(second))
        + f" else 0e0 end as e_{c}"
        for c, h in enumerate(HIDDEN)
    )
    taps_back = ", ".join(f"v.v_{k}" for k in range(len(second)))
    TABLES[f"{name}_all"] = (
        (f"{name}_h", f"{name}_v"),
        f"""select h.*, v.d, v.sq, {taps_back}, {errors} from {name}_h h join {name}_v v
            on v.node_id = h.node_id and v.t = h.t""",
    )
    parts = [[f"sum({x} * e_{c})" for c in range(len(HIDDEN))] for x in inputs]
    parts.append([f"sum(e_{c})" for c in range(len(HIDDEN))])
    parts += [[f"sum({h} * v_{k})" for h in HIDDEN] for k in range(len(second))]
    parts.append(["sum(d)", "sum(sq)", "cast(count(*) as double)", "0e0", "0e0", "0e0"])
    body = " union all ".join(
        f"select {n} as part, " + ", ".join(r6(g, f"g_{c}", 5) for c, g in enumerate(part, 1)) + f" from {name}_all"
        for n, part in enumerate(parts)
    )
    add(f"{name}_loss_gradient", body, f"{name}_all")


gradient_query("gcn", ["p0"], _gcn.weight[0], _gcn.bias[0], [[r[0] for r in _gcn.weight[1]]], _gcn.bias[1][0])
gradient_query(
    "cheb",
    ["t0", "t1", "t2"],
    [row for tap in _cheb.weight[0] for row in tap],
    _cheb.bias[0],
    [[r[0] for r in tap] for tap in _cheb.weight[1]],
    _cheb.bias[1][0],
)

_factors = [f"p0_{k}" for k in range(1, H + 1)] + ["1e0"]
add(
    "sgc_gram",
    " union all ".join(
        f"select {n} as row, "
        + ", ".join(r6(f"sum({a} * {b})", f"c_{m}", 5) for m, b in enumerate(_factors))
        + f", {r6(f'sum({a} * y)', 'c_y', 5)} from gcn_rows"
        for n, a in enumerate(_factors)
    ),
    "gcn_rows",
)

# Elimination by plain joins of the table with its pivot row; every column of the pivot is cleared in all other rows.
_columns = [f"c_{m}" for m in range(H + 1)] + ["c_y"]
TABLES["sweep_0"] = (
    ("gcn_rows",),
    " union all ".join(
        f"select {n} as row, " + ", ".join(f"sum({a} * {b}) as {c}" for b, c in zip([*_factors, "y"], _columns)) + " from gcn_rows"
        for n, a in enumerate(_factors)
    ),
)
for _k in range(H + 1):
    TABLES[f"sweep_{_k + 1}"] = (
        (f"sweep_{_k}",),
        "select a.row, "
        + ", ".join(f"case when a.row = {_k} then p.{c} / p.c_{_k} else a.{c} - a.c_{_k} / p.c_{_k} * p.{c} end as {c}" for c in _columns)
        + f" from sweep_{_k} a join sweep_{_k} p on p.row = {_k}",
    )
add("sgc_linear_fit", f"select row, {r6('c_y', 'value')} from sweep_{H + 1}", f"sweep_{H + 1}")
