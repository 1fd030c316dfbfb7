"""Hand-made standings files in the shape of the collected ones."""

import os

HEADER = "Pos,Team,P,W,D,L,GF,GA,W,D,L,GF,GA,GD,Pts,match_date"
RAW_HEADER = "Pos,Team,P, ,W,D,L,GF,GA, ,W,D,L,GF,GA, ,GD,Pts,match_date"


def line(pos, team, home, away, date):
    """A clean line; ``home`` and ``away`` are (W, D, L, GF, GA)."""
    both = [h + a for h, a in zip(home, away)]
    return [pos, team, sum(both[:3]), *home, *away, both[3] - both[4], 3 * both[0] + both[1], date]


def write(path, name, lines, header=HEADER):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as file:
        file.write("\n".join([header, *[",".join(map(str, row)) for row in lines]]) + "\n")


def with_gaps(row):
    return [*row[:3], " ", *row[3:8], " ", *row[8:13], " ", *row[13:]]


FIRST = [
    line(1, "North End", (2, 0, 0, 5, 1), (1, 1, 0, 3, 2), "2023-Mar-12"),
    line(2, "AFC  South", (1, 1, 0, 3, 1), (1, 0, 1, 2, 2), "2023-Mar-12"),
    line(3, "Easton", (0, 0, 2, 0, 4), (0, 0, 2, 1, 5), "2023-Mar-12"),
]
# North End plays, the others do not; Easton only changes its rank.
SECOND = [
    line(1, "North End", (3, 0, 0, 7, 1), (1, 1, 0, 3, 2), "2023-Mar-16"),
    line(2, "AFC  South", (1, 1, 0, 3, 1), (1, 0, 1, 2, 2), "2023-Mar-16"),
    line(4, "Easton", (0, 0, 2, 0, 4), (0, 0, 2, 1, 5), "2023-Mar-16"),
    line(3, "Westham", (1, 0, 1, 2, 3), (0, 1, 1, 1, 3), "2023-Mar-16"),
]
