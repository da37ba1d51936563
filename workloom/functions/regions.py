"""The region of a city: fixed federal districts, and the regions that a city table names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from workloom.functions.extract import load_reference

# Cities and subjects of each federal district, lower-cased, as the reference lists them.
CITIES = {
    "ЦФО": "москва|воронеж|белгород|брянск|владимир|иваново|калуга|кострома|курск|липецк|орёл|орел|рязань|смоленск|тамбов|тверь|тула|ярославль|подольск|химки|балашиха|королёв|королев|мытищи|люберцы|электросталь|серпухов",
    "СЗФО": "санкт-петербург|архангельск|великий новгород|вологда|калининград|мурманск|петрозаводск|псков|сыктывкар|северодвинск|череповец",
    "ЮФО": "краснодар|ростов-на-дону|ростов на дону|астрахань|волгоград|майкоп|севастополь|симферополь|сочи|анапа|геленджик|новороссийск|таганрог|элиста|шахты|армавир",
    "СКФО": "ставрополь|махачкала|грозный|владикавказ|нальчик|черкесск|магас|пятигорск|кисловодск|минеральные воды",
    "ПФО": "казань|нижний новгород|самара|уфа|пермь|ижевск|йошкар-ола|йошкар ола|киров|оренбург|пенза|саранск|саратов|тольятти|ульяновск|чебоксары|альметьевск|набережные челны|стерлитамак|энгельс|елабуга",
    "УФО": "екатеринбург|челябинск|тюмень|курган|магнитогорск|нижний тагил|сургут|нижневартовск|ханты-мансийск|ханты мансийск|салехард|ноябрьск|новый уренгой|верхняя пышма",
    "СФО": "новосибирск|барнаул|кемерово|красноярск|иркутск|омск|томск|абакан|горно-алтайск|горно алтайск|кызыл|новокузнецк|ангарск|братск|норильск",
    "ДФО": "владивосток|хабаровск|анадырь|биробиджан|благовещенск|магадан|петропавловск-камчатский|петропавловск камчатский|улан-удэ|улан удэ|чита|якутск|южно-сахалинск|южно сахалинск|комсомольск-на-амуре|комсомольск на амуре|уссурийск|находка",
}
SUBJECTS = {
    "ЦФО": "белгородская|брянская|владимирская|воронежская|ивановская|калужская|костромская|курская|липецкая|московская|орловская|рязанская|смоленская|тамбовская|тверская|тульская|ярославская|москва",
    "СЗФО": "карелия|коми|архангельская|вологодская|калининградская|ленинградская|мурманская|новгородская|псковская|ненецкий|санкт-петербург",
    "ЮФО": "адыгея|калмыкия|крым|краснодарский|астраханская|волгоградская|ростовская|севастополь",
    "СКФО": "дагестан|ингушетия|кабардино-балкарская|карачаево-черкесская|северная осетия|чеченская|ставропольский",
    "ПФО": "башкортостан|марий эл|мордовия|татарстан|удмуртская|чувашская|пермский|кировская|нижегородская|оренбургская|пензенская|самарская|саратовская|ульяновская",
    "УФО": "курганская|свердловская|тюменская|челябинская|ханты-мансийский|ямало-ненецкий",
    "СФО": "алтай|тыва|хакасия|алтайский|красноярский|иркутская|кемеровская|новосибирская|омская|томская",
    "ДФО": "бурятия|саха|якутия|забайкальский|камчатский|приморский|хабаровский|амурская|магаданская|сахалинская|еврейская|чукотский",
}


def _flat(districts: dict[str, str]) -> dict[str, str]:
    return {name: district for district, names in districts.items() for name in names.split("|")}


def subject_key(region: str) -> str:
    """A province without the word for its kind, as region_of looks it up."""
    text = re.sub(r"\s+(?:область|край|республика|автономн\S+\s+(?:область|округ)|ао|округ|г\.?)$", "", region.strip().lower())
    return re.sub(r"^республика\s+", "", text).strip()


def maps(cities: DataFrame) -> tuple[dict[str, str], dict[str, str]]:
    """(by_city, by_subject) for slim.region_of from a table of city, region and aliases of fixed size;
    its entries come before the federal districts, names before aliases."""
    rows = cities.where("city is not null and region is not null").select("city", "region", "aliases").orderBy("city_id").collect()
    by_city: dict[str, str] = {}
    for names in ([(r.city, r.region) for r in rows], [(a, r.region) for r in rows for a in r.aliases or [] if a]):
        for name, region in names:
            by_city.setdefault(name.strip().lower(), region)
    by_subject: dict[str, str] = {}
    for r in rows:
        by_subject.setdefault(subject_key(r.region), r.region)
    return _flat(CITIES) | by_city, _flat(SUBJECTS) | by_subject


def load(path: str) -> tuple[dict[str, str], dict[str, str]]:
    """(by_city, by_subject) from a YAML or JSON file {"cities": {name: region}, "subjects": {name: region}}."""
    content = load_reference(path) or {}
    flat = lambda part: {str(k).strip().lower(): v for k, v in (content.get(part) or {}).items() if v}
    return flat("cities"), flat("subjects")
