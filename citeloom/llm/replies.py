"""Problem 2: broken prompt and response pairs.

Method: a linear-chain conditional random field tags the clauses of a reply as ``answer``, ``refusal``, ``echo``,
``foreign`` or ``unfinished``; the share of the reply's characters under each tag decides the pair's defect.

The field is trained here, on clauses whose tags are known by construction: replies of a bounded sample of calls
(``TRAINING_CALLS``, by the hash of their ids) as answers, and the same replies after cutting them off, putting in
clauses of the prompt or of a reply in another language, or sentences that decline (``_REFUSALS``). Its features are
overlap with the prompt, language against the language asked for, how much a clause sounds like declining, and how often
a clause of this shape ends where it does, by counts over the whole table.

Declining and the languages in Latin letters are told by weights of hashed character n-grams (``Ngrams``), fitted on the
same sample: declining by logistic regression of the refusals against clauses of answers and prompts, where the field
learns from scores of a model that has not seen the sentence; languages by naive Bayes on texts of the sample that hold
small words of one language. Other languages are told by their script.

The corpus counts are made in one pass over all calls. Every shape seen twice counts, at any size: up to
``MOST_SHAPES`` are broadcast (their number is checked); of more, those with at least ``MIN_SHARE`` of all counts, which
cannot be more than 1 / MIN_SHARE, and the rarer ones stay in a table that is joined to the final clauses.

All user messages of a call are read: a reply may copy any of them, and the last paragraph that names a language says
which one is asked for; if none does, it is that of the instructions (the last paragraphs).

Defined results: a call recorded several times is judged once, by its last row in time order (its reply does not
differ); a null, blank, ``{}``, ``null`` or punctuation-only reply is ``empty``, as is a reply without description;
JSON that breaks off is ``truncated``; calls without a user message have no echo and no language; null ids are kept out.
"""

import json
import math
import re
import unicodedata
from collections import ChainMap, Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.plans.staging import staged

TAGS = ("answer", "refusal", "echo", "foreign", "unfinished")
TRAINING_CALLS, MIN_SHARE = 500, 2e-6
#: Longest character n-gram, bits of its bucket, scale of n-gram shares, and log odds that tell two languages apart.
LONGEST_GRAM, BUCKET_BITS, GRAM_SCALE, LANGUAGE_MARGIN = 4, 15, 8.0, 3.0
#: Shapes that are all broadcast.
MOST_SHAPES = 200_000
#: Calls whose clauses are looked up at once.
TOGETHER = 200
#: Letters from which a clause that stands in the prompt counts as echoed.
LEAST_ECHO = 8

#: Frequent small words of the languages in Latin letters.
_SMALL = {
    "en": "the of and to in is it at for on by with that which as be are has have not from this could would may they its than once if no a an will".split(),
    "de": "der die das und ist nicht von zu mit den im des ein eine einen für auf bei dem nach wenn was kann sollte sich nur zwei drei oder wird mir".split(),
    "fr": "le la les des de du et est un une en que qui dans pour pas par sur au aux chez ne se il soit mais dont cette sont je à".split(),
    "es": "el los las del y es en que un una por para con no se al su si qué hay podría ocurriría también riesgos decir lo de la o asume".split(),
}
_SCRIPTS = (("zh", "一-鿿㐀-䶿"), ("ru", "Ѐ-ӿ"), ("ar", "؀-ۿ"), ("hi", "ऀ-ॿ"), ("th", "ก-๛"))
#: Names of the languages as prompts write them.
_NAMED = {
    "en": "english|englisch|anglais|inglés|英语|英文|英語|английск|الإنجليزية|अंग्रेज़ी|ภาษาอังกฤษ",
    "de": "german|deutsch|allemand|alemán|德语|德文|ドイツ語|немецк|الألمانية|जर्मन|ภาษาเยอรมัน",
    "fr": "french|französisch|français|francés|法语|法文|フランス語|французск|الفرنسية|फ़्रेंच|ภาษาฝรั่งเศส",
    "es": "spanish|spanisch|espagnol|español|西班牙语|スペイン語|испанск|الإسبانية|स्पेनिश|ภาษาสเปน",
    "zh": "chinese|chinesisch|chinois|chino|中文|汉语|中国語|китайск|الصينية|चीनी|ภาษาจีน",
    "ja": "japanese|japanisch|japonais|japonés|日语|日文|日本語|японск|اليابانية|जापानी|ภาษาญี่ปุ่น",
    "ru": "russian|russisch|russe|ruso|俄语|ロシア語|русск|الروسية|रूसी|ภาษารัสเซีย",
    "ar": "arabic|arabisch|arabe|árabe|阿拉伯语|アラビア語|арабск|العربية|अरबी|ภาษาอาหรับ",
    "hi": "hindi|印地语|ヒンディー語|हिन्दी|हिंदी|хинди|الهندية|ภาษาฮินดี",
    "th": "thai|thailändisch|thaï|tailandés|泰语|タイ語|тайск|التايلاندية|थाई|ภาษาไทย",
}
#: Sentences that decline, for training, by language.
_REFUSALS = {
    "en": [
        "I’m sorry, I can’t do that.", "I am sorry, but I cannot assist with this.", "I can't help you with this one.", "Sorry, I won’t answer this.", "I must refuse to write that.", "I have to decline this request.",
        "Unfortunately I am unable to answer your request.", "I am not able to provide this record.", "As an AI I cannot judge companies.", "As a language model, I may not give such descriptions.", "I’d rather not comment on this material.",
        "I do not feel comfortable with this request.", "This goes beyond what I am allowed to answer.", "Your request falls outside of my rules.", "Please ask a qualified adviser instead; I won’t describe this.", "I will not process sensitive material.",
        "My guidelines do not permit me to help.", "Apologies, but I’m not allowed to do so.", "I decline to write it.", "No, I cannot write the description you ask for.", "I'm afraid I can't comply.", "That is nothing I may assess.",
    ],
    "de": [
        "Es tut mir leid, das kann ich nicht tun.", "Ich kann dabei leider nicht helfen.", "Ich muss das ablehnen.", "Das darf ich nicht beantworten.", "Leider kann ich diese Anfrage nicht bearbeiten.", "Ich darf dazu keine Beschreibung geben.",
        "Als Sprachmodell darf ich das nicht bewerten.", "Ich möchte darauf nicht antworten.", "Bitte wenden Sie sich an eine Fachperson, ich kann das nicht schreiben.", "Diese Bitte muss ich leider zurückweisen.",
    ],
    "fr": [
        "Je suis désolé, je ne peux pas faire cela.", "Je ne peux pas répondre à cette question.", "Désolé, cela m’est impossible.", "Je dois refuser cette demande.", "Il ne m’est pas permis de rédiger ce texte.", "Malheureusement je ne suis pas en mesure d’aider.",
        "En tant que modèle de langage, je ne peux pas évaluer cela.", "Je préfère ne pas répondre.", "Je regrette de ne pas pouvoir vous aider avec cette demande.", "Il m’est interdit de décrire cela.",
    ],
    "es": [
        "Lo siento, no puedo hacer eso.", "No puedo ayudar con esta solicitud.", "Debo rechazar esta petición.", "No me está permitido responder.", "Lamentablemente no soy capaz de escribir eso.", "Como modelo de lenguaje no puedo evaluarlo.",
        "Prefiero no responder a esto.", "Me niego a redactar ese texto.", "Lamento no poder ayudarle.", "No estoy autorizado a describir esto.",
    ],
    "zh": ["抱歉，我无法完成。", "对不起，我不能回答这个请求。", "很抱歉，我无法提供帮助。", "我必须拒绝这个请求。", "作为语言模型，我不能评估这些内容。", "很遗憾，我不便撰写该内容。", "我不被允许描述这一点。"],
    "ja": ["申し訳ありませんが、お答えできません。", "申し訳ございません、この依頼には対応できません。", "すみませんが、作成することはできません。", "お手伝いできません。", "ご依頼はお断りします。", "言語モデルとして評価することはできません。", "その記述をお書きすることはできかねます。"],
    "ru": ["Извините, я не могу ответить.", "К сожалению, я не могу помочь с этим.", "Я вынужден отказаться.", "Простите, я не могу этого сделать.", "Как языковая модель я не могу это оценивать.", "Я не вправе описывать это.", "Мне нельзя отвечать на этот запрос."],
    "ar": ["عذرا، لا أستطيع المساعدة.", "آسف، لا يمكنني الإجابة على هذا الطلب.", "أعتذر، لا يمكنني تقديم هذا الوصف.", "يجب أن أرفض هذا الطلب.", "بصفتي نموذجا لغويا لا يمكنني تقييم ذلك.", "لا يسمح لي بكتابة ذلك.", "للأسف لا أستطيع كتابة هذا."],
    "hi": ["क्षमा करें, मैं यह नहीं कर सकता।", "माफ़ कीजिए, मैं इस अनुरोध में मदद नहीं कर सकता।", "मुझे खेद है, मैं इसका उत्तर नहीं दे सकता।", "मुझे यह लिखने की अनुमति नहीं है।", "मैं इस अनुरोध को अस्वीकार करता हूँ।", "भाषा मॉडल के रूप में मैं इसका मूल्यांकन नहीं कर सकता।"],
    "th": ["ขออภัย ฉันไม่สามารถช่วยได้", "ขอโทษ ฉันไม่สามารถตอบคำขอนี้ได้", "เสียใจด้วย ฉันเขียนคำอธิบายนี้ไม่ได้", "ฉันต้องปฏิเสธคำขอนี้", "ในฐานะแบบจำลองภาษา ฉันไม่สามารถประเมินได้", "ฉันไม่ได้รับอนุญาตให้ตอบ"],
}
#: Ordinary sentences by language, for training, so that no language alone sounds like declining.
_ORDINARY = {
    "en": ["The company sells parts to many customers.", "I can lose an order if the price of steel rises.", "We were not able to deliver on time last year.", "Sales fell by a tenth in the second quarter.", "The request for a permit was not granted.", "What happens if a supplier stops its deliveries?"],
    "de": ["Das Unternehmen verkauft Teile an viele Kunden.", "Wenn der Preis für Stahl steigt, kann der Gewinn sinken.", "Der Umsatz ist im zweiten Quartal leider nicht gestiegen.", "Die Anfrage der Behörde wurde beantwortet.", "Wir können nicht ausschließen, dass Lieferungen ausfallen.", "Was geschieht, wenn ein Lieferant nicht mehr liefert?"],
    "fr": ["La société vend des pièces à de nombreux clients.", "Si le prix de l’acier monte, la marge peut baisser.", "La demande d’autorisation n’a pas été acceptée.", "Les ventes ont reculé au deuxième trimestre.", "Nous ne pouvons pas exclure un retard de livraison.", "Que se passe-t-il si un fournisseur ne livre plus ?"],
    "es": ["La empresa vende piezas a muchos clientes.", "Si sube el precio del acero, puede bajar el margen.", "La solicitud del permiso no fue aceptada.", "Las ventas cayeron en el segundo trimestre.", "No podemos descartar retrasos en las entregas.", "¿Qué ocurre si un proveedor deja de entregar?"],
    "zh": ["公司向许多客户销售零件。", "如果钢材价格上涨，利润可能下降。", "第二季度的销售额下降了一成。", "许可申请没有获得批准。", "我们无法排除交货延误的可能。"],
    "ja": ["会社は多くの顧客に部品を販売している。", "鋼材の価格が上がれば利益が減るおそれがある。", "第二四半期の売上は一割減少した。", "許可の申請は認められなかった。", "納期の遅れを避けることができない場合がある。"],
    "ru": ["Компания продаёт детали многим клиентам.", "Если цена стали вырастет, прибыль может снизиться.", "Во втором квартале продажи упали на десятую часть.", "Запрос на разрешение не был одобрен.", "Мы не можем исключить задержку поставок."],
    "ar": ["تبيع الشركة القطع لكثير من العملاء.", "إذا ارتفع سعر الفولاذ فقد تنخفض الأرباح.", "انخفضت المبيعات في الربع الثاني من العام.", "لم تتم الموافقة على طلب التصريح.", "لا يمكن للشركة أن تستبعد تأخر التسليم."],
    "hi": ["कंपनी कई ग्राहकों को पुर्ज़े बेचती है।", "यदि इस्पात का दाम बढ़ा तो लाभ घट सकता है।", "दूसरी तिमाही में बिक्री दस प्रतिशत घटी।", "परमिट का अनुरोध स्वीकार नहीं हुआ।", "कंपनी देरी से इनकार नहीं कर सकती।", "क्या वह समय पर काम पूरा कर पाएगी?"],
    "th": ["บริษัทขายชิ้นส่วนให้ลูกค้าจำนวนมาก", "หากราคาเหล็กสูงขึ้น กำไรอาจลดลง", "ยอดขายในไตรมาสที่สองลดลงหนึ่งในสิบ", "คำขอใบอนุญาตไม่ได้รับอนุมัติ", "โครงการจะล่าช้าและบริษัทต้องรับภาระเอง"],
}
_STOPS = ".!?。！？।॥؟｡"
_CLOSERS = "”»」』》）)]\"'’“"
_CLAUSE = re.compile(r"(?<=[!?。！？।॥؟])(?=[^”»」』)\]\"’])|(?<=[.!?؟।])(?<!\b\w\.)\s+(?=\W*[^\W\da-zа-яß-ÿ])|\n+")


_TONGUES = list(_SMALL)
_SMALL_SETS = {k: frozenset(v) for k, v in _SMALL.items()}
_LETTERS = re.compile(r"[^\W\d_]+")
_OTHER_SCRIPT = re.compile("[Ѐ-ӿ؀-ۿऀ-ॿก-๛぀-ヿ㐀-䶿一-鿿]")


def _by_script(text: str) -> str | None:
    """The language told by the script of a text: ``latin`` where no other script stands out, None without letters."""
    if not _OTHER_SCRIPT.search(text):
        return "latin" if _LETTERS.search(text) else None
    letters = sum(c.isalpha() for c in text)
    if not letters:
        return None
    kana = len(re.findall("[぀-ヿ]", text))
    counts = {lang: len(re.findall(f"[{chars}]", text)) for lang, chars in _SCRIPTS}
    if kana >= 2 and kana + counts["zh"] >= 0.15 * letters and kana >= 0.15 * (kana + counts["zh"]):
        return "ja"
    best = max(counts, key=counts.get)
    return best if counts[best] >= 0.2 * letters or counts[best] >= 8 and counts[best] >= 0.12 * letters else "latin"


def _by_small_words(text: str) -> str | None:
    words = _LETTERS.findall(text.casefold())
    scores = {lang: sum(w in small for w in words) for lang, small in _SMALL_SETS.items()}
    top = sorted(scores.values())
    return max(scores, key=scores.get) if top[-1] >= 2 and top[-1] > top[-2] else None


def language(text: str, ngrams: "Ngrams | None" = None) -> str | None:
    """The language of a text by script and, in Latin letters, by ``ngrams`` (without them by small words), or None where
    it shows too little."""
    found = _by_script(text)
    return found if found != "latin" else _by_small_words(text) if ngrams is None else ngrams.languages([text])[0]


def _hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of the letters of each text, and the text of each."""
    plain = [" " + " ".join(_LETTERS.findall(t.casefold())) + " " for t in texts]
    codes = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    of = np.repeat(np.arange(len(texts)), [len(t) for t in plain])
    at, owner, h = [], [], np.zeros(len(codes), np.uint64)
    for n in range(1, LONGEST_GRAM + 1):
        h = h[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :] + np.uint64(n)
        if n > 1:
            same = of[n - 1 :] == of[: len(of) - n + 1]
            mixed = h[same] ^ (h[same] >> np.uint64(31))
            at.append(((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
            owner.append(of[: len(of) - n + 1][same])
    return np.concatenate(at), np.concatenate(owner)


class Ngrams:
    """Weights of hashed character n-grams: how much a text sounds like declining, and its language in Latin letters."""

    def __init__(self, declines: np.ndarray, bias: float, tongues: np.ndarray):
        self.known: dict[str, str | None] = {}  # languages of instructions, which repeat
        self.table, self.bias, self.tongues = np.column_stack((declines, tongues)), bias, tongues

    @staticmethod
    def fit_declines(refusals: list[str], others: list[str], rounds: int = 40, rate: float = 0.5, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
        """Logistic regression on the shares of n-grams, both kinds weighing the same."""
        texts = refusals + others
        at, of = _hashed(texts)
        size = np.maximum(1, np.bincount(of, minlength=len(texts)))
        y = np.arange(len(texts)) < len(refusals)
        share = np.where(y > 0, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum()))
        x = GRAM_SCALE / size[of]
        weights, bias = np.zeros(1 << BUCKET_BITS), 0.0
        seen, seen_bias = np.full(1 << BUCKET_BITS, 1e-8), 1e-8
        for _ in range(rounds):
            score = np.bincount(of, weights[at] * x, len(texts)) + bias
            slope = share * (y - 1 / (1 + np.exp(-score)))
            grad = np.bincount(at, slope[of] * x, 1 << BUCKET_BITS) - ridge * weights
            seen += grad**2
            seen_bias += slope.sum() ** 2
            weights += rate * grad / np.sqrt(seen)
            bias += rate * slope.sum() / np.sqrt(seen_bias)
        return weights, bias

    @staticmethod
    def fit(texts: list[str], clauses_: list[str]) -> "Ngrams":
        """``texts`` of any language; ``clauses_`` that decline nothing."""
        rows = np.zeros((1 << BUCKET_BITS, len(_SMALL)))
        labelled = [(t, lang) for t in texts if _by_script(t) == "latin" and (lang := _by_small_words(t))]
        labelled += [(" ".join(words), lang) for lang, words in _SMALL.items()]
        at, of = _hashed([t for t, _ in labelled])
        kinds = np.array([list(_SMALL).index(lang) for _, lang in labelled])
        np.add.at(rows, (at, kinds[of]), 1)
        rows = np.log((rows + 0.1) / (rows + 0.1).sum(0))
        return Ngrams(*_single(Ngrams.fit_declines(_all_refusals(), clauses_)), rows.astype(np.float32))

    def sums(self, texts: list[str]) -> np.ndarray:
        """For each text the sum of its declining weights, the log likelihood of each language, and its n-grams."""
        at, of = _hashed(texts)
        found = self.table[at]
        return np.stack([*(np.bincount(of, found[:, k], len(texts)) for k in range(found.shape[1])), np.bincount(of, minlength=len(texts))], 1)

    def declining(self, sums: np.ndarray) -> np.ndarray:
        """Log odds that texts decline, within -4 and 4."""
        return np.clip(np.where(sums[:, -1] > 0, sums[:, 0] * GRAM_SCALE / np.maximum(1, sums[:, -1]) + self.bias, -4), -4, 4)

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.declining(self.sums(texts))

    @staticmethod
    def tongue(sums: np.ndarray) -> str | None:
        """The language of a text in Latin letters; None where two are too close."""
        second, first = np.sort(sums[1:-1])[-2:]
        return _TONGUES[int(sums[1:-1].argmax())] if first - second >= LANGUAGE_MARGIN else None

    def languages(self, texts: list[str]) -> list[str | None]:
        return [self.tongue(row) for row in self.sums(texts)]


def _all_refusals() -> list[str]:
    return [t for texts in _REFUSALS.values() for t in texts]


def _paragraphs(message: str) -> list[str]:
    return [p for p in message.split("\n\n") if p.strip()]


def _printed(users: list[str]) -> list[str]:
    """The texts that user messages give: all paragraphs but the last, or the whole of a single one."""
    return [p for u in users for parts in [_paragraphs(u)] for p in parts[: max(1, len(parts) - 1)]]


def wanted_language(users: list[str] | str, ngrams: Ngrams | None = None) -> str | None:
    """The language the user messages ask for, by the last paragraph that names one; if none does, that of the
    instructions, the last paragraphs. The first paragraph of a longer message is the text it gives."""
    messages = [parts for u in ([users] if isinstance(users, str) else users) if (parts := _paragraphs(u))]
    for parts in reversed(messages):
        for paragraph in reversed(parts[1:] or parts):
            if named := _named(paragraph):
                return named
    known = {} if ngrams is None else ngrams.known
    for parts in messages:
        if parts[-1] not in known:
            if len(known) > 10_000:
                known.clear()
            known[parts[-1]] = language(parts[-1], ngrams)
        if known[parts[-1]]:
            return known[parts[-1]]
    return None


@lru_cache(10_000)
def _named(paragraph: str) -> str | None:
    """The one language that a paragraph names."""
    named = [lang for lang, names in _NAMED_RE.items() if names.search(paragraph)]
    return named[0] if len(named) == 1 else None


_NAMED_RE = {lang: re.compile(names, re.I) for lang, names in _NAMED.items()}


def unwrap(reply: str | None, kind: str) -> tuple[str, bool]:
    """What is judged of a reply, and whether its JSON breaks off."""
    if reply is None:
        return "", False
    body = re.sub(r"^\s*```\w*\s*|\s*```\s*$", "", reply).strip()
    try:
        value = json.loads(body)
    except ValueError:
        return body, body[:1] in "{[" and _open_ended(body)
    if value is None or value == {} or value == []:
        return "", False
    if isinstance(value, str):
        return value, False
    if isinstance(value, dict) and kind != "intent":
        text = value.get("description")
        return (text if isinstance(text, str) else "" if text is None else json.dumps(text, ensure_ascii=False)), False
    return body, False


def _open_ended(body: str) -> bool:
    depth, inside, skip = 0, False, False
    for c in body:
        if skip:
            skip = False
        elif inside:
            skip, inside = c == "\\", c != '"'
        elif c == '"':
            inside = True
        elif c in "{[":
            depth += 1
        elif c in "}]":
            depth -= 1
    return inside or depth > 0


def clauses(text: str) -> list[str]:
    return [c for part in _CLAUSE.split(text) if (c := part.strip())]


class _Kept(dict):
    """Letters, digits and combining marks as they are, anything else as nothing."""

    def __missing__(self, code: int) -> int | None:
        c = chr(code)
        self[code] = code if c.isalnum() or unicodedata.category(c) in ("Mn", "Mc") else None
        return self[code]


_KEPT = _Kept()


def _bare(text: str) -> str:
    """Letters and digits only, in one case and form: what is left for the comparison with the prompt."""
    return (text if text.isascii() else unicodedata.normalize("NFKC", text)).casefold().translate(_KEPT)


#: Capitalised words of five letters and more; shorter ones are mostly titles, units and abbreviations.
_NAME = re.compile(r"[A-ZÀ-Þ][a-zà-ÿ]{4,}")


def shape(clause: str) -> list[str]:
    """The clause as tokens, capitalised Latin words after the first and figures made alike; single characters where
    the script puts no blanks."""
    text = re.sub(r"\d[\d.,]*", "0", clause.strip().rstrip(_STOPS + _CLOSERS + "… "))
    if re.search("[぀-ヿ一-鿿ก-๛]", text):
        return list(re.sub(r"[^\W\d_぀-ヿ一-鿿ก-๛]+", "N", text).replace(" ", ""))
    first, *words = text.split() or [""]
    return [first.rstrip(".,;:") or first, *map(_formed, words)] if first else []


@lru_cache(1 << 16)
def _formed(word: str) -> str:
    """A word of a shape after its first one."""
    word = word.rstrip(".,;:") or word
    return "N" if _NAME.match(word.lstrip("“«„(¿¡")) else word.casefold()


def _ends(tokens: list[str]) -> tuple[int, str, str, str]:
    """How many last tokens tell an end, the shape's last tokens, its first tokens, and both ends."""
    k = 4 if tokens and len(tokens[-1]) == 1 and len(tokens[0]) == 1 and not tokens[0].isascii() else 2
    first = tokens[0] if len(tokens[0]) > 1 and not _NAME.match(tokens[0]) else "N"
    head = first + " " + " ".join(tokens[1:2])
    return k, " ".join(tokens[-k:]), head, head + "|" + tokens[-1]


def evidence(text: str, finished: bool) -> list[tuple[str, str]]:
    """What a text gives to the counts: ``e`` last tokens at an end, ``m`` the same tokens inside a clause, ``f`` start and
    last token of a clause that ends, ``g`` its start. ``finished`` counts the last clause as ended though it has no stop."""
    out: list[tuple[str, str]] = []
    parts = clauses(text)
    for n, clause in enumerate(parts):
        tokens = shape(clause)
        if not tokens:
            continue
        k, tail, head, both = _ends(tokens)
        for width in (k, 2 * k):
            out += [("m", " ".join(tokens[i - width : i])) for i in range(width, len(tokens))]
        if clause.rstrip(_CLOSERS)[-1:] in _STOPS or finished and n == len(parts) - 1:
            out += [("e", tail), ("f", both), ("g", head)]
            if len(tokens) >= 2 * k:
                out.append(("e", " ".join(tokens[-2 * k :])))
    return out


def _left_open(clause: str) -> bool:
    """Whether a quotation or bracket opened in the clause is not closed in it."""
    n = clause.count
    german = n("„")
    return n("«") > n("»") or n("(") > n(")") or n("「") > n("」") or (german > n("“") if german else n("“") > n("”"))


def _ending(clause: str, counts: dict) -> list[float]:
    """Of a final clause: ends without stop, breaks off with an ellipsis or an open quotation, and two log odds that a
    clause of this shape ends here."""
    core = clause.rstrip().rstrip(_CLOSERS)
    dots = core.endswith(("...", "…")) or _left_open(clause)
    tokens = shape(clause) if dots or core[-1:] not in _STOPS else []
    if not tokens:
        return [0.0, 0.0, 0.0, 0.0]
    k, tail, head, both = _ends(tokens)
    longer = " ".join(tokens[-2 * k :])
    if len(tokens) >= 2 * k and counts.get(("e", longer), 0) - 1 + counts.get(("m", longer), 0) >= 3:
        tail = longer  # known in its longer form
    # Less one: this clause itself was counted as an end.
    e, m = max(0, counts.get(("e", tail), 0) - 1), counts.get(("m", tail), 0)
    f, g = max(0, counts.get(("f", both), 0) - 1), counts.get(("g", head), 0)
    odds = [math.log((e + 0.2) / (m + 0.2)), math.log((f + 0.2) / (0.005 * g + 0.2))]
    return [1.0, float(dots), *(max(-4.0, min(4.0, o)) for o in odds)]


def features(parts: list[str], user_bare: str, wanted: str | None, counts: dict, ngrams: Ngrams, bares: list[str] | None = None, sums: np.ndarray | None = None) -> np.ndarray:
    """One row per clause: bias, echoed, language differs, language unknown, sounds like declining, and of the last one
    ``_ending``. ``sums`` are the clauses' ``Ngrams.sums`` where they are known."""
    out = np.zeros((len(parts), 9))
    sums = ngrams.sums(parts) if sums is None else sums
    declines, whole = ngrams.declining(sums), _by_script(" ".join(parts))
    whole = ngrams.tongue(sums.sum(axis=0)) if whole == "latin" else whole
    tongues = [ngrams.tongue(row) if (script := _by_script(part)) == "latin" else script for part, row in zip(parts, sums)]
    for i, (clause, bare) in enumerate(zip(parts, bares or map(_bare, parts))):
        own = tongues[i] or whole
        row = out[i]
        row[0] = 1
        row[1] = len(bare) >= LEAST_ECHO and bare in user_bare
        row[2] = bool(wanted and own and own != wanted)
        row[3] = own is None
        row[4] = declines[i]
    out[-1, 5:] = _ending(parts[-1], counts)
    return out


class ChainField:
    """A linear-chain conditional random field with dense features, trained by gradient ascent."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move

    @staticmethod
    def fit(data: list[tuple[np.ndarray, np.ndarray]], tags: int, rounds: int = 150, rate: float = 0.3, ridge: float = 1e-3) -> "ChainField":
        longest, width = max(len(y) for _, y in data), data[0][0].shape[1]
        x = np.zeros((len(data), longest, width))
        y = np.zeros((len(data), longest), int)
        mask = np.zeros((len(data), longest), bool)
        for n, (a, b) in enumerate(data):
            x[n, : len(b)], y[n, : len(b)], mask[n, : len(b)] = a, b, True
        hot = np.eye(tags)[y] * mask[..., None]
        steps = np.einsum("nti,ntj->ij", hot[:, :-1], hot[:, 1:])
        emit, move = np.zeros((width, tags)), np.zeros((tags, tags))
        s = [np.zeros_like(emit), np.zeros_like(move)]
        flat = x.reshape(-1, width)
        for _ in range(rounds):
            # Forward and backward in scaled probabilities: each step is one small matrix product.
            unary = (flat @ emit).reshape(len(data), longest, tags)
            own, step = np.exp(unary - unary.max(axis=2, keepdims=True)), np.exp(move - move.max())
            alpha, scale = np.zeros_like(own), np.ones((len(data), longest, 1))
            scale[:, 0] = own[:, 0].sum(axis=1, keepdims=True)
            alpha[:, 0] = own[:, 0] / scale[:, 0]
            for t in range(1, longest):
                nxt = alpha[:, t - 1] @ step * own[:, t]
                scale[:, t] = nxt.sum(axis=1, keepdims=True)
                alpha[:, t] = nxt / scale[:, t]
            beta = np.ones_like(own)
            ahead = own / scale
            for t in range(longest - 2, -1, -1):
                beta[:, t] = np.where(mask[:, t + 1, None], (ahead[:, t + 1] * beta[:, t + 1]) @ step.T, 1)
            p = alpha * beta
            p = p / p.sum(axis=2, keepdims=True) * mask[..., None]
            later = ahead[:, 1:] * beta[:, 1:] * mask[:, 1:, None]
            pair = np.einsum("nti,ntj->ij", alpha[:, :-1], later) * step
            for k, (w, grad) in enumerate(((emit, flat.T @ (hot - p).reshape(-1, tags)), (move, steps - pair))):
                grad = grad / len(data) - ridge * w
                s[k] += grad**2
                w += rate * grad / np.sqrt(s[k] + 1e-8)
        return ChainField(emit, move)

    def tag(self, x: np.ndarray) -> list[int]:
        unary = x @ self.emit
        best, back = unary[0], []
        for row in unary[1:]:
            score = best[:, None] + self.move
            back.append(score.argmax(0))
            best = score.max(0) + row
        path = [int(best.argmax())]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        return path[::-1]


def _clean(replies: list[tuple[list[str], str]], ngrams: Ngrams | None) -> list[tuple[list[str], str, list[str]]]:
    """(user messages, language asked for, clauses) of the sample's sound answers."""
    out = []
    for users, text in replies:
        parts, want = clauses(text), wanted_language(users, ngrams)
        if parts and want and text.rstrip()[-1] in _STOPS and language(text, ngrams) == want and _bare(parts[0]) not in "\n".join(map(_bare, users)):
            out.append((users, want, parts))
    return out


def fit_ngrams(replies: list[tuple[list[str], str]]) -> tuple[Ngrams, list[tuple[list[str], Ngrams]]]:
    """The n-gram weights, fitted on the sample's texts, and each half of the refusals with weights fitted on the other.

    The clauses of all replies count as declining nothing at first; those that sound like it all the same, which are the
    few refusals of the sample, are left out of the second fit.
    """
    texts = sorted({p for users, text in replies for p in [*(q for u in users for q in _paragraphs(u)), text]})
    printed = {c for users, _ in replies for p in _printed(users) for c in clauses(p)} | {c for some in _ORDINARY.values() for c in some}
    answers = sorted({c for _, text in replies for c in clauses(text)} - printed)
    first = Ngrams.fit(texts, sorted(printed) + answers)
    sound = sorted(printed) + [c for c, x in zip(answers, first.scores(answers)) if x < 0] if answers else sorted(printed)
    refusals = _all_refusals()
    halves = [(refusals[k::2], Ngrams(*_single(Ngrams.fit_declines(refusals[1 - k :: 2], sound)), first.tongues)) for k in (0, 1)]
    return Ngrams(*_single(Ngrams.fit_declines(refusals, sound)), first.tongues), halves


def _single(weights: tuple[np.ndarray, float]) -> tuple[np.ndarray, float]:
    return weights[0].astype(np.float32), weights[1]


def training_data(replies: list[tuple[list[str], str]], counts: dict, ngrams: Ngrams, halves: list[tuple[list[str], Ngrams]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Tagged clause rows of (user messages, judged text) pairs and of their broken versions. ``halves`` are refusals,
    each with the weights of a model that was fitted without them."""
    rnd = np.random.default_rng(11)
    clean = [(u, w, p) for u, w, p in _clean(replies, ngrams) if ngrams.scores([" ".join(p)])[0] < 0]
    by_language: dict[str, list[list[str]]] = {}
    for _, want, parts in clean:
        by_language.setdefault(want, []).append(parts)
    data = []

    def add(parts, tags, bare, want, model=ngrams):
        if parts:
            data.append((features(parts, bare, want, counts, model), np.array([TAGS.index(t) for t in tags])))

    for n, (users, want, parts) in enumerate(clean):
        bare = "\n".join(map(_bare, users))
        add(parts, ["answer"] * len(parts), bare, want)
        bald = [*parts[:-1], parts[-1].rstrip(_STOPS)]
        add(bald, ["answer"] * len(bald), bare, want)
        last = parts[-1]
        cut = last[: max(1, int(len(last) * rnd.uniform(0.15, 0.85)))].rstrip()
        if cut.rstrip(_CLOSERS)[-1:] not in _STOPS:
            cut += "..." if n % 5 == 0 else ""
            add([*parts[:-1], cut], ["answer"] * (len(parts) - 1) + ["unfinished"], bare, want)
        unseen, model = halves[n % len(halves)]
        if n % 4 < 3:  # mostly in the language asked for, as it is not the language that makes a refusal
            unseen = [t for t in unseen if t in _REFUSALS.get(want, ())] or unseen
        refuse = [unseen[int(k)] for k in rnd.integers(0, len(unseen), 1 + n // 2 % 2)]
        add(refuse, ["refusal"] * len(refuse), bare, want, model)
        printed = [c for p in _printed(users) for c in clauses(p)]
        add(printed, ["echo"] * len(printed), bare, want)
        if printed and n % 3 == 0:
            add([*parts, printed[-1]], ["answer"] * len(parts) + ["echo"], bare, want)
        others = [p for lang, texts in by_language.items() if lang != want for p in texts]
        if others:
            other = others[int(rnd.integers(0, len(others)))]
            add(other, ["foreign"] * len(other), bare, want)
    return data


class _Pending(NamedTuple):
    """A reply that the field has to judge: its clauses, bare and as they are, and what they are compared with."""

    parts: list[str]
    bares: list[str]
    user_bare: str
    language: bool


def _by_rule(kind: str, users: list[str], reply: str | None) -> str | _Pending | None:
    """The defect that the reply itself shows, None for a sound intent, else what the field has to judge."""
    text, broken = unwrap(reply, kind)
    if broken:
        return "truncated"
    said = re.sub(r"[\W_]+", "", text)
    if not said or said.casefold() in ("na", "none", "null", "nil", "nan", "tbd"):
        return "empty"
    if kind == "intent" and text[:1] == "{":
        return None
    bare = "\n".join(map(_bare, users))
    mine = _bare(text)
    if mine in bare or mine and mine == bare.replace("\n", ""):
        return "copy"
    parts = clauses(text)
    return _Pending(parts, list(map(_bare, parts)), bare, kind != "intent") if parts else None


def _by_field(p: _Pending, users: list[str], model: "tuple[ChainField, Ngrams]", counts: dict, sums: np.ndarray | None = None) -> str | None:
    """The defect that the field's tags give, by the share of characters under each."""
    field, ngrams = model
    share: Counter = Counter()
    wanted = wanted_language(users, ngrams) if p.language else None
    for own, tag in zip(p.bares, field.tag(features(p.parts, p.user_bare, wanted, counts, ngrams, p.bares, sums))):
        share[TAGS[tag]] += max(1, len(own))
        final = TAGS[tag]
    total = sum(share.values())
    if share["refusal"] >= 0.5 * total:
        return "refusal"
    if share["echo"] >= 0.999 * total and all(b in p.user_bare for b in p.bares):
        return "copy"  # and nothing of its own
    if final == "unfinished":
        return "truncated"
    if p.language and share["foreign"] > 0.5 * total:
        return "language"
    return None


def defect(kind: str, users: list[str], reply: str | None, model: "tuple[ChainField, Ngrams] | None", counts: dict) -> str | None:
    """The defect of one call, or None."""
    found = _by_rule(kind, users, reply)
    return found if not isinstance(found, _Pending) else None if model is None else _by_field(found, users, model, counts)


def judged_calls(calls: DataFrame) -> DataFrame:
    """One row per call: ``call_id, kind, users, response_content``."""
    users = F.transform(F.filter("messages", lambda m: m["role"] == "user"), lambda m: F.coalesce(m["content"], F.lit("")))
    return (
        calls.where(F.col("call_id").isNotNull() & (F.size(F.coalesce("messages", F.array())) > 0))
        .select("call_id", F.split_part("call_id", F.lit("-"), F.lit(1)).alias("kind"), users.alias("users"), "response_content", "created_at")
        .groupBy("call_id")
        .agg(F.max_by(F.struct("kind", "users", "response_content"), F.struct("created_at", F.xxhash64("response_content"))).alias("r"))
        .select("call_id", "r.*")
    )


class _Asked(dict):
    """Counts of nothing that keep the shapes they were asked for."""

    def get(self, key, default=None):
        self[key] = default
        return default


def corpus_counts(judged: DataFrame) -> tuple[dict[tuple[str, str], int], DataFrame | None]:
    """The counts of ``evidence`` over all replies and printed texts: of frequent shapes, and a table of the rarer ones
    where there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter = Counter()
            for kind, users, reply in zip(*(batch.column(c).to_pylist() for c in ("kind", "users", "response_content"))):
                if kind != "intent":
                    text, broken = unwrap(reply, kind)
                    total.update(evidence(text, not broken))
                    for printed in _printed(users):
                        total.update(evidence(printed, True))
            if total:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in total]), pa.array([w for _, w in total]), pa.array(total.values(), pa.int64())], names=["kind", "word", "n"])

    counts = judged.select("kind", "users", "response_content").mapInArrow(run, "kind string, word string, n long").groupBy("kind", "word").agg(F.sum("n").alias("n"))
    counts = staged(counts.where("n >= 2"), "shapes")
    total = counts.agg(F.sum("n")).first()[0] or 0
    if counts.limit(MOST_SHAPES + 1).count() <= min(MOST_SHAPES, 1 / MIN_SHARE if MIN_SHARE else MOST_SHAPES):
        return {(r[0], r[1]): r[2] for r in counts.collect()}, None
    least = max(2.0, MIN_SHARE * total)
    rare = counts.where((F.col("n") >= 2) & (F.col("n") < least)) if least > 2 else None
    return {(r[0], r[1]): r[2] for r in counts.where(F.col("n") >= least).collect()}, rare


def _with_rare(judged: DataFrame, rare: DataFrame) -> DataFrame:
    """``judged`` with the counts of the rare shapes that its final clauses ask for in ``rare``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for call, kind, reply in zip(*(batch.column(c).to_pylist() for c in ("call_id", "kind", "response_content"))):
                asked = _Asked()
                for final in clauses(unwrap(reply, kind)[0] or "")[-1:]:
                    _ending(final, asked)
                found += [(call, k, w) for k, w in asked]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], pa.string()) for i in range(3)], names=["call_id", "kind", "word"])

    asked = judged.select("call_id", "kind", "response_content").mapInArrow(run, "call_id string, kind string, word string")
    counts = asked.join(rare, ["kind", "word"]).groupBy("call_id").agg(F.collect_list(F.struct("kind", "word", "n")).alias("rare"))
    return judged.join(counts, "call_id", "left")


def train(judged: DataFrame, counts: dict, bound: int = TRAINING_CALLS, rare: DataFrame | None = None) -> tuple[ChainField, Ngrams] | None:
    """The field and its n-gram weights, fitted on at most ``bound`` calls; None where they hold no clean answer."""
    rows = judged.where("kind <> 'intent' AND response_content IS NOT NULL").orderBy(F.xxhash64("call_id"), "call_id").limit(bound).select("kind", "users", "response_content").collect()
    pairs = [(list(r["users"]), text) for r in rows for text, broken in [unwrap(r["response_content"], r["kind"])] if text and not broken]
    if not pairs:
        return None
    ngrams, halves = fit_ngrams(pairs)
    if rare is not None:
        training_data(pairs, asked := _Asked(), ngrams, halves)
        if asked:
            own = judged.sparkSession.createDataFrame(sorted(asked), "kind string, word string")
            counts = ChainMap({(r["kind"], r["word"]): r["n"] for r in own.join(rare, ["kind", "word"]).collect()}, counts)
    data = training_data(pairs, counts, ngrams, halves)
    return (ChainField.fit(data, len(TAGS)), ngrams) if data else None


def defects(calls: DataFrame) -> DataFrame:
    """(call_id, defect) of the calls whose reply is no proper answer."""
    judged = staged(judged_calls(calls), "calls")
    counts, rare = corpus_counts(judged)
    shared = calls.sparkSession.sparkContext.broadcast((train(judged, counts, rare=rare), counts))
    judged = judged.withColumn("rare", F.lit(None).cast("array<struct<kind:string,word:string,n:bigint>>")) if rare is None else _with_rare(judged, rare)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value
        for batch in batches:
            ids, found = [], []
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("call_id", "kind", "users", "response_content", "rare"))))
            for at in range(0, len(rows), TOGETHER):
                some = [(row, _by_rule(*row[1:4])) for row in rows[at : at + TOGETHER]]
                asked = [p for _, p in some if isinstance(p, _Pending)]
                sums = iter(np.split(model[1].sums([c for p in asked for c in p.parts]), np.cumsum([len(p.parts) for p in asked])[:-1]) if model and asked else ())
                for (call, _, users, _, own), d in some:
                    if isinstance(d, _Pending):
                        extra = {(r["kind"], r["word"]): r["n"] for r in own or ()}
                        d = _by_field(d, users, model, ChainMap(extra, known) if extra else known, next(sums)) if model else None
                    if d:
                        ids.append(call), found.append(d)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.string())], names=["call_id", "defect"])

    return judged.mapInArrow(run, "call_id string, defect string")
