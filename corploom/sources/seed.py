"""Seed table of languages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LANGUAGE_SCHEMA = (
    "language_ru string, language_en string, family string, branch string, iso639_3 string, opus_code string"
)

# language_ru, language_en, family, branch, iso639_3, opus_code.
LANGUAGES = [
    ("татарский", "Tatar", "Тюркская", "кыпчакская", "tat", "tt"),
    ("башкирский", "Bashkir", "Тюркская", "кыпчакская", "bak", "ba"),
    ("чувашский", "Chuvash", "Тюркская", "огурская", "chv", "chv"),
    ("якутский / саха", "Sakha / Yakut", "Тюркская", "сибирская", "sah", "sah"),
    ("тувинский", "Tuvan", "Тюркская", "сибирская", "tyv", "tyv"),
    ("хакасский", "Khakas", "Тюркская", "сибирская", "kjh", "kjh"),
    ("алтайский", "Altai", "Тюркская", "сибирская", "alt", "alt"),
    ("кумыкский", "Kumyk", "Тюркская", "кыпчакская", "kum", "kum"),
    ("карачаево-балкарский", "Karachay-Balkar", "Тюркская", "кыпчакская", "krc", "krc"),
    ("ногайский", "Nogai", "Тюркская", "кыпчакская", "nog", "nog"),
    ("крымскотатарский", "Crimean Tatar", "Тюркская", "кыпчакско-огузская", "crh", "crh"),
    ("удмуртский", "Udmurt", "Уральская", "пермская", "udm", "udm"),
    ("коми-зырянский", "Komi-Zyrian", "Уральская", "пермская", "kpv", "kpv"),
    ("коми-пермяцкий", "Komi-Permyak", "Уральская", "пермская", "koi", "koi"),
    ("эрзянский", "Erzya", "Уральская", "мордовская", "myv", "myv"),
    ("мокшанский", "Moksha", "Уральская", "мордовская", "mdf", "mdf"),
    ("марийский луговой", "Meadow Mari", "Уральская", "марийская", "mhr", "mhr"),
    ("марийский горный", "Hill Mari", "Уральская", "марийская", "mrj", "mrj"),
    ("карельский", "Karelian", "Уральская", "прибалтийско-финская", "krl", "krl"),
    ("вепсский", "Veps", "Уральская", "прибалтийско-финская", "vep", "vep"),
    ("хантыйский", "Khanty", "Уральская", "угорская", "kca", None),
    ("мансийский", "Mansi", "Уральская", "угорская", "mns", "mns"),
    ("ненецкий", "Nenets", "Уральская", "самодийская", "yrk", "yrk"),
    ("чеченский", "Chechen", "Северокавказская", "нахская", "che", "ce"),
    ("ингушский", "Ingush", "Северокавказская", "нахская", "inh", "inh"),
    ("аварский", "Avar", "Северокавказская", "нахско-дагестанская", "ava", "av"),
    ("даргинский", "Dargwa", "Северокавказская", "нахско-дагестанская", "dar", "dar"),
    ("лезгинский", "Lezgian", "Северокавказская", "нахско-дагестанская", "lez", "lez"),
    ("лакский", "Lak", "Северокавказская", "нахско-дагестанская", "lbe", "lbe"),
    ("рутульский", "Rutul", "Северокавказская", "нахско-дагестанская", "rut", "rut"),
    ("адыгейский", "Adyghe", "Северокавказская", "абхазо-адыгская", "ady", "ady"),
    ("кабардино-черкесский", "Kabardian", "Северокавказская", "абхазо-адыгская", "kbd", "kbd"),
    ("абазинский", "Abaza", "Северокавказская", "абхазо-адыгская", "abq", None),
    ("бурятский", "Buryat", "Монгольская", "монгольская", "bxr", "bxr"),
    ("калмыцкий", "Kalmyk", "Монгольская", "ойратская", "xal", "xal"),
    ("эвенкийский", "Evenki", "Тунгусо-маньчжурская", "тунгусская", "evn", "evn"),
    ("нанайский", "Nanai", "Тунгусо-маньчжурская", "тунгусская", "gld", "gld"),
    ("нивхский", "Nivkh", "изолят / палеоазиатская группа", "нивхская", "niv", None),
    ("чукотский", "Chukchi", "чукотско-камчатская", "чукотская", "ckt", None),
    ("корякский", "Koryak", "чукотско-камчатская", "чукотская", "kpy", None),
    ("алеутский", "Aleut", "эскимосско-алеутская", "алеутская", "ale", "ale"),
    ("эскимосский / юпик", "Yupik", "эскимосско-алеутская", "эскимосская", "ess", None),
]


def languages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LANGUAGES, LANGUAGE_SCHEMA)
