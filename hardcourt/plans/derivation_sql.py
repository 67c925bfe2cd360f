"""The derivation in SQL: one common table per stage, from `raw` (the event contract, with home and away) to `done`."""

from __future__ import annotations

from hardcourt.operators import derive, pbp

BEFORE, AFTER = "rows between unbounded preceding and 1 preceding", "rows between 1 following and unbounded following"


def names(found: list[str]) -> str:
    return "(" + ", ".join(f"'{n}'" for n in found) + ")"


def w(*keys: str, desc: bool = False) -> str:
    return f"partition by {', '.join(('game_id', *keys))} order by seq"


def past(test: str, value: str, *keys: str) -> str:
    return f"last_value(case when {test} then {value} end ignore nulls) over ({w(*keys)} {BEFORE})"


def ahead(test: str, value: str, *keys: str) -> str:
    return f"first_value(case when {test} then {value} end ignore nulls) over ({w(*keys)} {AFTER})"


def within(aggregate: str, *keys: str) -> str:
    return f"{aggregate} over (partition by {', '.join(('game_id', *keys))})"


def errors(*found: tuple[str, str]) -> str:
    return "list_concat(errors, list_filter([" + ", ".join(f"case when {test} then '{rule}' end" for test, rule in found) + "], lambda x: x is not null))"


FT, REB, FOUL, STD, FG, MAKE, MISS, SHOT, POSS = (f"event in {names(x)}" for x in (pbp.FTS, pbp.REBOUNDS, pbp.FOULS, pbp.STANDARD_FOULS, pbp.FIELD_GOALS, pbp.FG_MAKES, pbp.MISSES, pbp.SHOTS, pbp.POSSESSION))
MARK, SUB = "event in ('poss_start', 'poss_end')", "event in ('player_in', 'player_out')"
OWN = "not starts_with(source, 'derived')"
_OTHER = "case team_id when home then away when away then home end"


def order(skip: list[str]) -> str:
    return f"coalesce(sum(case when event not in {names(skip)} then 1 else 0 end) over ({w()} {BEFORE}), 0)"


def trips(src: str, out: str) -> str:
    """Per foul and its free throws their number, first and last; and whether a make is taken up by the trip behind it."""
    return f"""
{out}_t as (select *, case when {FT} then chain_id when {FOUL} then event_id end as trip from {src}),
{out}_n as (select *, case when trip is null then 0 else count(*) filter (where {FT}) over (partition by game_id, trip) end as trip_n,
  case when trip is not null then max(case when {FT} then seq end) over (partition by game_id, trip) end as trip_last,
  case when trip is not null then min(case when {FT} then seq end) over (partition by game_id, trip) end as trip_first,
  case when trip is not null then min(case when {FT} then team_id end) over (partition by game_id, trip) end as trip_t0,
  case when trip is not null then max(case when {FT} then team_id end) over (partition by game_id, trip) end as trip_t1,
  ({FT}) and trip is not null and coalesce(bool_or({STD}) over (partition by game_id, trip), false) as standard from {out}_t),
{out}_a as (select *, {ahead(f"event not in {names(pbp.ASSISTS)}", "{'ev': event, 'e': event_id, 'n': trip_n, 't0': trip_t0, 't1': trip_t1}", "period")} as nx from {out}_n),
{out}_b as (select *, coalesce(({MAKE}) and nx.ev in {names(pbp.STANDARD_FOULS)} and nx.n > 0 and nx.t0 = team_id and nx.t1 = team_id, false) as absorbed from {out}_a),
{out}_c as (select *, case when absorbed then nx.e else trip end as and_one from {out}_b),
{out} as (select *, and_one is not null and bool_or(absorbed) over (partition by game_id, and_one) as after_make from {out}_c)"""


CONTRACT = "game_id, event_id, secs, period, team_id, player_id, event, chain_id, fouled_player_id, source, errors, home, away"


def row(base: str, slot: str, more: str = "", **change: str) -> str:
    """What a row becomes, with its order key; derived rows are new ones."""
    values = {n: n for n in CONTRACT.split(", ")}
    by = "null::varchar as bt, null::varchar as bp"
    if "source" in change:
        team = change.get("team_id", "team_id")
        values |= {"event_id": f"'D:' || event_id || ':{slot}:' || {team}", "chain_id": "null::varchar", "fouled_player_id": "null::varchar", "player_id": "''", "errors": "[]::varchar[]"}
        if "starter" in change["source"] or "lineup" in change["source"]:
            by = "team_id as bt, player_id as bp"
    values |= change
    return f"{base} as base, {slot} as slot, {by}, seq as was_seq, {', '.join(f'{v} as {n}' for n, v in values.items())}{more}"


def placed(src: str, out: str, rows: list[tuple[str, str]], keep: str = "") -> str:
    union = " union all ".join(f"select {r} from {src} where {test}" for test, r in rows)
    return f"""
{out}_r as ({union}),
{out} as (select {CONTRACT}{keep}, (row_number() over (partition by game_id order by base, slot, bt nulls first, bp nulls first, was_seq) - 1)::int as seq from {out}_r)"""


CHAINED = f"""
c0 as (select *, {order(derive.FOUL_SKIP)} as o1, {order(derive.REBOUND_SKIP)} as o2 from raw),
c1 as (select *, {past(FOUL, "{'o': o1, 'e': event_id, 'ev': event}")} as f, {past(MISS, "{'o': o2, 'p': period, 'e': event_id, 't': team_id, 's': seq}")} as m,
  {ahead(f"event not in {names(derive.REBOUND_SKIP)}", "{'ev': event, 'e': event_id, 't': team_id, 's': seq}", "period")} as h from c0),
c2 as (select * exclude (f), case when o1 - f.o - 1 <= {derive.MAX_GAP} then f end as f, case when {REB} then
    case when o2 - m.o - 1 <= {derive.MAX_GAP} and m.p = period then {{'e': m.e, 't': m.t, 's': m.s}} when h.ev in {names(pbp.SHOTS)} then {{'e': h.e, 't': h.t, 's': h.s}} end end as shot from c1),
c3 as (select * exclude (event, chain_id, errors), {errors((f"{FT} and f is null", "ft_without_foul"), (f"{REB} and shot is null", "rebound_no_shot"))} as errors,
  case when event = 'rebound' and shot is not null then case when shot.t = team_id then 'o_reb' else 'd_reb' end else event end as event,
  case when {FT} then f.e when {REB} then shot.e else chain_id end as chain_id from c2),
c3p as (select * exclude (seq), (row_number() over (partition by game_id order by case when {REB} and shot is not null then shot.s else seq end, case when {REB} and shot is not null then 1 else 0 end, case when {REB} and shot is not null then -seq else seq end) - 1)::int as seq from c3),
c4 as (select *, case when {FT} then chain_id when {FOUL} then event_id end as ftrip from c3p),
c5 as (select *, case when ftrip is null then 0 else count(*) filter (where {FT}) over (partition by game_id, ftrip) end as shots from c4),
c6 as (select *, {ahead("event <> 'block'", "{'ev': event, 'fp': fouled_player_id, 'n': shots}", "period")} as nb, {past("event <> 'block'", "{'ev': event, 'pl': player_id}", "period")} as pb from c5),
c7a as (select *, coalesce(event in {names(pbp.FG_MISSES)} and nb.ev in {names(pbp.STANDARD_FOULS)} and nb.fp = player_id and nb.n > 0, false) as fouled,
  coalesce({STD} and pb.ev in {names(pbp.FG_MISSES)} and pb.pl = fouled_player_id and shots > 0, false) as record from c6),
c7b as (select * exclude (errors), {errors(("record", "fouled_shot_miss"))} as errors, bool_or(fouled) over (partition by game_id, event_id) as gone from c7a),
c7c as (select * exclude (gone, fouled, record, nb, pb, ftrip, shots) from c7b where not gone),
{trips("c7c", "c7")},
c8 as (select *, case when {SHOT} then event_id when {REB} then chain_id end as key from c7),
c9 as (select *, {within(f"bool_or(case when {FT} and seq < trip_last then true when absorbed then true else false end)", "key")} as inner_, count(*) filter (where {REB}) over ({w("key")} rows unbounded preceding) as nth,
  coalesce({FOUL} and trip_n > 0 and first_value(period) over (partition by game_id, trip order by case when {FT} then seq end nulls last) <> period, false) as across,
  first_value(period) over (partition by game_id, trip order by case when {FT} then seq end nulls last) as p0, first_value(secs) over (partition by game_id, trip order by case when {FT} then seq end nulls last) as s0 from c8),
c10 as (select * exclude (period, secs), case when across then p0 else period end as period, case when across then s0 else secs end as secs,
  case when across then trip_first else seq end as base, case when across then -5 else 0 end as slot
  from c9 where not ({REB} and chain_id is not null and (inner_ or nth > 1))),
chained as (select {CONTRACT}, (row_number() over (partition by game_id order by base, slot, seq) - 1)::int as seq from c10)"""


def lined_up(size: int = 5) -> str:
    src, keys = "(not starts_with(source, 'derived') and team_id <> '')", ("period", "team_id", "player_id")
    wrong = [(f"event = 'period_start' and {n} {op} {size}", f"lineup_too_{s}") for op, s in (("<", "small"), (">", "large")) for n in ("n_home", "n_away")]
    sweep = "case when e is not null then e.secs else b.secs end"
    return f"""
l0 as (select *, {src} and event in {names(pbp.COURT)} and player_id <> '' as active, bool_or(event = 'player_in') over (partition by game_id, event_id) and bool_or(event = 'player_out') over (partition by game_id, event_id) as paired from chained),
l1 as (select *, min(case when active then seq end) over (partition by game_id, period, team_id) as first_active from l0),
l2 as (select *, {src} and {SUB} and paired and period > 1 and (first_active is null or seq < first_active) as boundary from l1),
l3 as (select *, case when ({src} and event = 'player_in') or active then 'in' when {src} and event = 'player_out' and not boundary then 'out' end as kind from l2),
l4 as (select *, coalesce({past("kind is not null", "kind", *keys)} = 'in', false) as was_in, {ahead("kind is not null", "kind", *keys)} as later from l3),
l5 as (select *, coalesce((kind is not null and not was_in and (active or kind = 'out')) or (boundary and event = 'player_in'), false) as starts,
  {within("min(case when event = 'period_start' then {'seq': seq, 'secs': secs} end)", "period")} as b, {within("max(case when event = 'period_end' then {'seq': seq, 'secs': secs} end)", "period")} as e, {within("max(seq)", "period")} as last_seq from l4),
l6 as (select *, starts and b is not null and count(*) filter (where starts) over ({w(*keys)} rows unbounded preceding) = 1 as first_start, coalesce(b is not null and kind = 'in' and later is null, false) as sweeps from l5),
l7 as (select *, {within("count(*) filter (where sweeps and team_id = home)", "period")} as n_home, {within("count(*) filter (where sweeps and team_id = away)", "period")} as n_away from l6),
l8 as (select * exclude (errors), {errors((f"{src} and event = 'player_in' and not boundary and was_in", "player_in_twice"), ("event = 'period_start' and e is null", "missing_period_end"), *wrong)} as errors from l7),
{placed("l8", "lined", [
    ("not boundary", row("seq", "0")),
    ("first_start", row("b.seq", "2", event="'player_in'", player_id="player_id", secs="b.secs", source="'derived:starter'")),
    ("sweeps", row("coalesce(e.seq, last_seq)", "5", event="'player_out'", player_id="player_id", secs=sweep, source="'derived:lineup_sweep'")),
])}"""  # fmt: skip


SCORED = f"""
{trips("lined", "s0")},
s1 as (select *, {FG} as fg, {POSS} as ind, ({FG}) or standard or ({POSS}) as relevant from s0),
s2 as (select *, {past("relevant", "{'t': team_id, 'p': ind}")} as pv from s1),
s3 as (select *, coalesce(fg and (pv is null or pv.p or pv.t <> team_id), false) as fg_opens from s2),
s4 as (select *, {past("standard or ind or fg_opens", "{'t': case when standard then chain_id end}")} as tv from s3),
s5 as (select *, fg_opens or coalesce(standard and not after_make and not coalesce(tv.t = chain_id, false), false) as opens from s4),
s6 as (select *, {ahead("relevant", "{'c': ind or opens}")} as nv from s5),
s7 as (select *, {MISS} and (fg or standard) and coalesce(nv.c, true) as final, ({MAKE} and not absorbed) or (standard and event <> 'ft_miss' and seq = trip_last) as live from s6),
{placed("s7", "s8", [
    ("true", row("seq", "0", ", final, live")),
    ("opens", row("seq", "-1", ", false as final, false as live", event="'pot_poss_ending_scoring_opp'", player_id="player_id", chain_id="event_id", source="'derived:scoring_opp'")),
], ", final, live")},
scored as (select * exclude (final, live), coalesce(final and {OWN}, false) as final, coalesce(live and {OWN}, false) as live from s8)"""  # fmt: skip

_TO = "case when event = 'd_reb' then team_id else other end"
#: Possession as a walk, an event of every game a step: who has the ball before it (was), and whether a turnover by the wrong
#: team stands since it last changed hands (spent).
_MOVED = f"""case when event = 'period_start' then {{'t': first_t, 'w': false}} when event = 'period_end' then {{'t': null::varchar, 'w': false}}
    when event = 'jump_ball_win' then case when jump and was is not null and was <> team_id and not spent then {{'t': team_id, 'w': false}} else {{'t': was, 'w': spent}} end
    when event in ('turnover', 'd_reb') or live then case
      when was is null and not live then {{'t': {_TO}, 'w': false}}
      when was = case when event = 'd_reb' then other else team_id end then {{'t': {_TO}, 'w': false}}
      else {{'t': was, 'w': spent or (event = 'turnover' and {OWN})}} end
    when lost then {{'t': case when was is null or was = team_id then reb else was end, 'w': false}}
    when soft and was is null then {{'t': team_id, 'w': false}}
    else {{'t': was, 'w': spent}} end"""


def mark(test: str, slot: str, event: str, team: str) -> tuple[str, str]:
    return f"({test}) and {team} is not null", row("seq", slot, event=f"'{event}'", team_id=team, source=f"'derived:{event}'")


POSSESSED = f"""
p0 as (select *, {_OTHER} as other, case when {MISS} then event_id when {REB} then chain_id end as key, {ahead(f"{POSS} or event = 'period_end'", "{'ev': event, 't': team_id}")} as np,
  min(case when event = 'turnover' and {OWN} then seq end) over ({w()} rows between 1 following and {derive.MAX_GAP + 1} following) as near, {ahead("event = 'period_end'", "seq")} as stop,
  count(*) filter (where event in ('period_start', 'period_end')) over ({w()} rows unbounded preceding) as bound from scored),
p1 as (select *, case when final and not {within(f"bool_or({REB})", "key")} then case when np.ev = 'period_end' then other else np.t end end as reb,
  event = 'jump_ball_win' and not (near is not null and (stop is null or near < stop)) as jump, case when np.ev <> 'period_end' then np.t end as first_t from p0),
p2 as (select *, coalesce(({POSS} and event not in ('turnover', 'd_reb', 'jump_ball_win')) or reb = team_id, false) as soft, coalesce(reb <> team_id, false) as lost from p1),
p3 as (select *, coalesce((event = 'period_start' and first_t is not null) or event in ('turnover', 'd_reb') or soft or reb is not null, false) as opens from p2),
p4 as (select *, coalesce(bool_or(opens) over ({w("bound")} {BEFORE}), false) as held from p3),
p5 as materialized (select * from p4),
walked as (select *, null::varchar as was, false as spent from p5 where seq = 0
  union all select p.*, m.t, m.w from (select game_id, seq, {_MOVED} as m from walked) s join p5 p on p.game_id = s.game_id and p.seq = s.seq + 1),
p8 as (select *, {_TO} as dest from walked),
p9 as (select *, (event in ('turnover', 'd_reb') or live) and dest is not null and (was is null or was <> dest) and (was is not null or not live) as changes, soft and was is null as opened,
  jump and not spent and was is not null and was <> team_id as jumped, lost and (was is null or was = team_id) as gives from p8),
p10 as (select * exclude (errors), {errors(("(event = 'turnover' and was <> team_id) or (live and was is not null and was <> team_id) or (lost and was is not null and was <> team_id)", "poss_mismatch"),
  (f"({POSS} and event not in ('turnover', 'd_reb', 'jump_ball_win') and was is not null and was <> team_id) or (reb is not null and not lost and was is not null and was <> reb)", "poss_change_without_transition"))} as errors from p9),
{placed("p10", "held_", [
    ("true", row("seq", "0")),
    mark("event = 'period_start'", "1", "poss_start", "first_t"),
    mark("event = 'period_end'", "1", "poss_end", "was"),
    mark("changes", "1", "poss_end", "was"),
    mark("changes", "2", "poss_start", "dest"),
    mark("opened and reb is null", "-1", "poss_start", "team_id"),
    mark("opened and reb is not null", "2", "poss_start", "team_id"),
    ("jumped", row("seq", "-3", event="'turnover'", team_id="was", chain_id="event_id", source="'derived:jump_ball_turnover'")),
    mark("jumped", "-2", "poss_end", "was"),
    mark("jumped", "-1", "poss_start", "team_id"),
    mark("gives", "1", "poss_end", "was"),
    mark("gives", "2", "poss_start", "reb"),
    ("reb is not null", row("seq", "3", event="case when lost then 'd_reb' else 'o_reb' end", team_id="reb", chain_id="event_id", source="'derived:team_rebound'")),
])}"""  # fmt: skip

CLEANED = f"""
k0 as (select *, sum(case when {POSS} then 1 else 0 end) over ({w("team_id")} rows unbounded preceding) as n from held_),
k1 as (select *, {ahead(MARK, "{'ev': event, 'n': n}", "team_id")} as nx, {past(MARK, "{'ev': event, 'n': n}", "team_id")} as pv from k0),
k2 as (select * exclude (seq, nx, pv, n), (row_number() over (partition by game_id order by seq) - 1)::int as seq from k1
  where not coalesce((event = 'poss_start' and nx.ev = 'poss_end' and nx.n = n) or (event = 'poss_end' and pv.ev = 'poss_start' and pv.n = n), false)),
k3 as (select * exclude (secs), case when secs is null and event in {names(pbp.CLOCK)} then ({past(POSS, "{'s': secs}", "period")}).s else secs end as secs from k2),
k4 as (select *, {past(MARK, "event", "team_id")} as pm, {ahead(MARK, "event", "team_id")} as nm, max(case when event = 'period_end' then seq end) over (partition by game_id) as fin,
  case event when 'player_in' then 1 when 'player_out' then -1 else 0 end as step, {ahead(SUB, "event", "team_id", "player_id")} as later from k3),
k5 as (select *, coalesce(sum(step) over ({w("team_id", "player_id")} {BEFORE}), 0) as court, sum(step) over (partition by game_id, team_id, player_id) as remaining, coalesce({OWN} and seq > fin, false) as late from k4),
done as (select * exclude (errors), {errors(
    (f"{STD} and coalesce(fouled_player_id = '', true)", "foul_without_fouled_player"),
    ("event = 'poss_start' and pm = 'poss_start'", "double_poss_open"),
    ("event = 'poss_end' and coalesce(pm = 'poss_end', true)", "poss_end_no_open"),
    ("event = 'poss_start' and nm is null", "poss_marker_unpaired"),
    ("late", "activity_after_end"),
    (f"{OWN} and event = 'player_out' and court <= 0", "player_out_not_on_court"),
    ("event = 'player_in' and remaining > 0 and later is null", "player_marker_unpaired"),
    (f"event in {names(pbp.COURT)} and team_id <> '' and player_id <> '' and event not in {names(derive.OFF_COURT_EXEMPT)} and court <= 0 and not late", "event_off_court"),
)} as errors from k5)"""  # fmt: skip

DERIVED = ",".join((CHAINED, lined_up(), SCORED, POSSESSED, CLEANED))
