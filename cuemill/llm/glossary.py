"""An input table for problem 1: names in other languages and standard short forms of subject names.

It is general reference content, written entry by entry of the canonical list in German, French and Spanish, whatever stands in
the data; any other table of (name, form) does as well, and the operator works without one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cuemill.llm.terms import ALIASES

#: Canonical name: German, French and Spanish name.
TRANSLATIONS: dict[str, tuple[str, str, str]] = {
    "particle physics": ("Teilchenphysik", "physique des particules", "física de partículas"),
    "astronomy": ("Astronomie", "astronomie", "astronomía"),
    "molecular biology": ("Molekularbiologie", "biologie moléculaire", "biología molecular"),
    "geology": ("Geologie", "géologie", "geología"),
    "machine learning": ("maschinelles Lernen", "apprentissage automatique", "aprendizaje automático"),
    "web development": ("Webentwicklung", "développement web", "desarrollo web"),
    "database systems": ("Datenbanken", "bases de données", "bases de datos"),
    "computer security": ("IT-Sicherheit", "sécurité informatique", "seguridad informática"),
    "contract law": ("Vertragsrecht", "droit des contrats", "derecho contractual"),
    "criminal procedure": ("Strafprozessrecht", "procédure pénale", "procedimiento penal"),
    "intellectual property": ("geistiges Eigentum", "propriété intellectuelle", "propiedad intelectual"),
    "labour law": ("Arbeitsrecht", "droit du travail", "derecho laboral"),
    "track and field": ("Leichtathletik", "athlétisme", "atletismo"),
    "football tactics": ("Fußballtaktik", "tactique du football", "táctica de fútbol"),
    "strength training": ("Krafttraining", "musculation", "entrenamiento de fuerza"),
    "rock climbing": ("Klettern", "escalade", "escalada"),
    "cardiology": ("Kardiologie", "cardiologie", "cardiología"),
    "emergency medicine": ("Notfallmedizin", "médecine d'urgence", "medicina de urgencias"),
    "nutrition science": ("Ernährungswissenschaft", "nutrition humaine", "ciencia de la nutrición"),
    "mental health": ("psychische Gesundheit", "santé mentale", "salud mental"),
    "personal finance": ("private Finanzen", "finances personnelles", "finanzas personales"),
    "corporate accounting": ("Unternehmensbuchhaltung", "comptabilité d'entreprise", "contabilidad empresarial"),
    "stock markets": ("Aktienmärkte", "marchés boursiers", "mercados bursátiles"),
    "tax planning": ("Steuerplanung", "planification fiscale", "planificación fiscal"),
    "ancient history": ("Alte Geschichte", "histoire antique", "historia antigua"),
    "military history": ("Militärgeschichte", "histoire militaire", "historia militar"),
    "economic history": ("Wirtschaftsgeschichte", "histoire économique", "historia económica"),
    "archaeology": ("Archäologie", "archéologie", "arqueología"),
    "music theory": ("Musiktheorie", "théorie musicale", "teoría musical"),
    "sound engineering": ("Tontechnik", "ingénierie du son", "ingeniería de sonido"),
    "guitar technique": ("Gitarrentechnik", "technique de guitare", "técnica de guitarra"),
    "choral singing": ("Chorgesang", "chant choral", "canto coral"),
    "bread baking": ("Brotbacken", "boulangerie maison", "panadería"),
    "fermentation": ("Fermentierung", "fermentation", "fermentación"),
    "pastry arts": ("Konditorei", "pâtisserie", "pastelería"),
    "knife skills": ("Messertechnik", "techniques de couteau", "técnica de cuchillo"),
    "civil engineering": ("Bauingenieurwesen", "génie civil", "ingeniería civil"),
    "electronics": ("Elektronik", "électronique", "electrónica"),
    "mechanical design": ("mechanische Konstruktion", "conception mécanique", "diseño mecánico"),
    "robotics": ("Robotik", "robotique", "robótica"),
    "soil science": ("Bodenkunde", "science du sol", "ciencia del suelo"),
    "fruit growing": ("Obstbau", "arboriculture fruitière", "fruticultura"),
    "greenhouse farming": ("Gewächshausanbau", "culture sous serre", "cultivo en invernadero"),
    "garden design": ("Gartengestaltung", "aménagement de jardin", "diseño de jardines"),
    "oil painting": ("Ölmalerei", "peinture à l'huile", "pintura al óleo"),
    "portrait photography": ("Porträtfotografie", "photographie de portrait", "fotografía de retrato"),
    "film editing": ("Filmschnitt", "montage vidéo", "montaje cinematográfico"),
    "typography": ("Typografie", "typographie", "tipografía"),
}
#: Standard short forms and dictionary synonyms.
SHORT: dict[str, tuple[str, ...]] = {
    "particle physics": ("HEP", "high energy physics"), "geology": ("earth science",), "machine learning": ("ML",), "web development": ("webdev",),
    "database systems": ("DBMS", "databases"), "computer security": ("infosec",), "labour law": ("employment law",), "track and field": ("athletics",),
    "nutrition science": ("dietetics",), "stock markets": ("equities",), "soil science": ("pedology",), "intellectual property": ("IP rights",),
    "hash table": ("hashmap",), "garbage collection": ("GC",), "public key cryptography": ("PKC", "asymmetric cryptography"), "cell membrane": ("plasma membrane",),
    "isotope dating": ("radiometric dating",), "spectral line": ("emission line",), "burden of proof": ("onus probandi",), "statutory limitation": ("limitation period",),
    "injunctive relief": ("injunction",), "heart rate zone": ("HR zone",), "blood pressure": ("BP",), "randomised trial": ("RCT",), "cognitive therapy": ("CBT",),
    "index fund": ("passive fund",), "price earnings ratio": ("P/E",), "time signature": ("metre",), "sourdough starter": ("levain",), "maillard browning": ("maillard effect",),
    "inverse kinematics": ("IK",), "finite element mesh": ("FE mesh",), "pulse width modulation": ("PWM",), "depth of field": ("DOF",), "microphone placement": ("mic placement",),
}


def glossary(spark: SparkSession) -> DataFrame:
    """(name, form)."""
    rows = [(name, form) for table in (TRANSLATIONS, SHORT) for name, forms in table.items() for form in forms]
    return spark.createDataFrame(rows, ALIASES)
