"""The two sample articles and helpers to build raw rows."""

LONG = "Un contenu assez long pour passer la validation, avec des mots divers et plus de cent signes au total, oui."

SAMPLE = [
    {
        "titre": "Test Article 1",
        "url": "https://www.hespress.com/test-123456.html",
        "date_publication": "2026-05-11T10:00:00Z",
        "categorie": "Politique",
        "auteur": "A. Auteur",
        "contenu": "Ceci est un article de test pour vérifier le workflow du projet Architecture. "
        "Le contenu est suffisamment long pour passer la validation.",
        "source": "hespress",
    },
    {
        "titre": "Test Article 2",
        "url": "https://www.hespress.com/test-789012.html",
        "date_publication": "2026-05-11T11:00:00Z",
        "categorie": "Sport",
        "auteur": "A. Auteur",
        "contenu": "Un autre article de test pour s'assurer que le traitement par lot fonctionne "
        "correctement dans le pipeline Airflow.",
        "source": "hespress",
    },
]

RAW = (
    "bronze_key string, pos int, dt string, titre string, url string, date_publication string, "
    "categorie string, auteur string, contenu string, source string"
)


def raw(spark, *rows):
    """Raw rows from (bronze_key, pos, changes to a valid article)."""
    valid = {
        "titre": "Titre", "url": "https://a.b/c", "date_publication": "2026-05-09", "categorie": "C",
        "auteur": "A", "contenu": LONG, "source": "goud",
    }
    full = [(key, pos, "2026-05-10", *{**valid, **changes}.values()) for key, pos, changes in rows]
    return spark.createDataFrame(full, RAW)
