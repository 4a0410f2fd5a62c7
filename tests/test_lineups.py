from agendario.operators import lineups
from agendario.operators.matching import Rules


def test_line_ups(spark):
    rows = [
        (1, 1, 2, ["Pirata Festival 2026 (Boikot, Evaristo y más)"], None), (1, 2, 1, ["PIRATA FEST", "EVARISTO", "Sho Hai", "Banda"], None), (1, 3, 3, ["Pirata Madrid Festival: Boikots + Nuevo Artista"], None), (1, 4, 4, ["Pirata"], None),
        (2, 5, 1, ["Kings of Noise", "Guest"], None), (3, 6, 1, ["Noche Sur", "Uno Dos", "TBA"], True), (3, 7, 2, ["Otro Fest", "Tres Cuatro"], None), (4, 8, 1, ["Mad Fest"], None),
    ]
    got = lineups.line_ups(spark.createDataFrame(rows, "cluster_id long, row_id long, priority int, names array<string>, festival boolean"), Rules(generic=frozenset(["banda"])), ("tba",))
    assert {r.cluster_id: (r.festival, r.artists, r.incomplete) for r in got.collect()} == {
        1: ("PIRATA FEST", ["EVARISTO", "Sho Hai", "Boikot", "Nuevo Artista"], True), 3: ("Noche Sur", ["Uno Dos", "Tres Cuatro"], False), 4: ("Mad Fest", [], False),
    }
