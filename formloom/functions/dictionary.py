"""Correction dictionaries for recognised text.

Keys mix Latin and Cyrillic letters of the same shape, byte for byte as recognition confuses them.
Pairs of a word with itself mark words that count as corrected.
"""

# What recognition reads -> what is meant, matched exactly.
EXACT = {
    "Homep": "Номер",
    "Номео": "Номер",
    "НомеD": "Номер",
    "PeB": "Рев",
    "Pев": "Рев",
    "РeB": "Рев",
    "Wmyyep": "Изделие",
    "Изделuе": "Изделие",
    "Изделиe": "Изделие",
    "Дaта": "Дата",
    "Датa": "Дата",
    "ne ugim": "не соответствует",
    "не соотвтствует": "не соответствует",
    "не cоответствует": "не соответствует",
    "друие несоотвтствуя": "другие несоответствия",
    "другие нeсоответствия": "другие несоответствия",
    "годн": "годен",
    "годeн": "годен",
    "бракк": "брак",
    "браk": "брак",
    "пригоден": "годен",
    "непригоден": "брак",
    "ГЕОМЕТРИЯ": "ГЕОМЕТРИЯ",
    "ГЕОМЕТРUЯ": "ГЕОМЕТРИЯ",
    "ГЕОМЕТРИR": "ГЕОМЕТРИЯ",
    "ОТВЕРСТИЯ": "ОТВЕРСТИЯ",
    "ОТВЕРСТUЯ": "ОТВЕРСТИЯ",
    "ОТВЕРСТИR": "ОТВЕРСТИЯ",
    "РЕЗЬБА": "РЕЗЬБА",
    "РЕЗЬБA": "РЕЗЬБА",
    "РEЗЬБА": "РЕЗЬБА",
    "Кол-во": "Кол-во",
    "Кол-вo": "Кол-во",
    "Коп-во": "Кол-во",
    "Решение": "Решение",
    "Решенuе": "Решение",
    "Решениe": "Решение",
    "Описание": "Описание",
    "Описанuе": "Описание",
    "Описаниe": "Описание",
    "Параметр": "Параметр",
    "Параметp": "Параметр",
    "Парамeтр": "Параметр",
    "Норма": "Норма",
    "Нормa": "Норма",
    "Фактически": "Фактически",
    "Фактичeски": "Фактически",
    "Контролер": "Контролер",
    "Контpолер": "Контролер",
    "Контролеp": "Контролер",
    "Подпись": "Подпись",
    "Подпuсь": "Подпись",
    "Подписъ": "Подпись",
    "Устранить": "Устранить",
    "Устpанить": "Устранить",
    "Устранитъ": "Устранить",
    "Доработать": "Доработать",
    "Доработатъ": "Доработать",
    "Доpаботать": "Доработать",
    "Утилизировать": "Утилизировать",
    "Утилизиpовать": "Утилизировать",
    "мм": "мм",
    "MM": "мм",
    "шт": "шт",
    "ШТ": "шт",
    "шт.": "шт",
}

# The same for lower-cased text, where no exact key matches.
FOLDED = {
    "номер": "Номер",
    "дата": "Дата",
    "рев": "Рев",
    "изделие": "Изделие",
    "годен": "годен",
    "брак": "брак",
}
