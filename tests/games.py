"""Micro-games in a short notation: `row event team/player secs`, `+` for the second event of a row."""

GAMES = {
    "G-A": """1 period_start - 0|2 jump_ball_win H 0|3 fg2_make H/h1 10|4 fg3_miss A/a1 20|5 rebound H/h1 22|6 turnover H/h1 30|6+ steal A/a1 30|7 d_standard_foul H/h1 40 a1|8 ft1_make A/a1 40|9 ft1_make A/a1 40|10 fg2_miss H/h1 55|11 period_end - 60""",
    "G-B": """1 period_start - 0|2 fg2_make H/h1 12|2+ fg2_assist H/h2 12|3 d_standard_foul A/a1 12 h1|4 ft_miss H/h1 12|5 rebound A/a1 14|6 steal A/a2 20|7 period_end - 60""",
    "G-C": """1 period_start - 0|2 fg3_miss H/h1 15|3 turnover H/h1 20|4 fg2_miss A/a1 35|5 rebound A/a1 36|6 fg2_make A/a1 38|7 fg2_miss H/h1 50|8 rebound H/h1 51|9 jump_ball_win A 55|10 period_end - 60""",
    "G-D": """1 period_start - 0|2 fg2_make H/h1 10|3 fg2_make A/a1 20|4 player_in H/h2 30|4+ player_out H/h1 30|5 d_standard_foul A/a1 59 h2|6 period_end - 60|@2|7 period_start - 60|8 player_in A/a2 60|8+ player_out A/a1 60|9 ft1_make H/h2 60|10 ft1_make H/h2 60|11 fg2_miss A/a2 80|12 rebound A/a2 81|13 turnover A/a2 90|14 period_end - 120""",
    "G-F": """1 period_start - 0|2 turnover A/a1 5|3 fg2_miss H/h1 10|3+ block A/a1 10|4 d_standard_foul A/a1 10 h1|5 ft1_make H/h1 10|6 ft1_make H/h1 10|7 turnover A/a1 20|8 period_end - 60""",
    "G-E": """1 period_start - ?|2 fg2_make H/h1 10|3 turnover H/h1 20|4 rebound A/a1 25|5 ft1_make A/a1 30|6 period_end - ?""",
}


def events(name: str) -> list[tuple]:
    """Rows of the event contract."""
    out, period = [], 1
    for item in GAMES[name].split("|"):
        if item[0] == "@":
            period = int(item[1:])
            continue
        parts = item.split()
        team, _, player = ("" if parts[2] == "-" else parts[2]).partition("/")
        secs = None if parts[3] == "?" else int(parts[3])
        out.append(("src", name, parts[0].rstrip("+"), len(out), secs, period, team, player, parts[1], None, parts[4] if len(parts) > 4 else None, parts[0].rstrip("+")))
    return out


SCHEMA = "identity string, game_id string, event_id string, seq int, secs int, period int, team_id string, player_id string, event string, chain_id string, fouled_player_id string, source string"
