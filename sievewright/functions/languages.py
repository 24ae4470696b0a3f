"""Language of a text by script and character trigrams, for twenty languages.

A script that one language alone uses decides at once: letters are counted by script, and the script of most letters wins.
Latin texts are scored by trigrams of letters and blanks: log-likelihoods under twelve tables, made from each
language's commonest words by one rule (trigrams of the words with their blanks, earlier words weighing more, smoothed
by single letters).  Confidence is the share of letters in the chosen script, times the likelihood of the best language
among the twelve.
"""

from __future__ import annotations

import math
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from sievewright.functions.markup import by_size

#: Scripts, as the names of Unicode classes, and the language each stands for; Latin is decided by trigrams (fixed values).
SCRIPTS = {"Hebrew": "he", "Arabic": "ar", "Devanagari": "hi", "Thai": "th", "Hangul": "ko", "Cyrillic": "ru", "Han": "zh", "Latin": None}
#: Kana stand for Japanese from this share of the letters that are kana or Han on.
KANA_SHARE = 0.1

#: The commonest words of the languages that share the Latin script, the most common first (fixed values).
WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei ich mich wir uns mein ihr wenn kann können doch dann unter soll schon jahre zwei diese dieser wieder keine uhr seiner worden will zwischen immer was sagte gibt alle seit muss weil jetzt möchte bitte danke konto schreiben nachdem letzten",
    "en": "the of and to in a is that it was for on are as with his they be at one have this from or had by not but what all were we when your can said there use an each which she do how their if will up other about out many then them these so some her would make like him into time has look two more write go see number no way could people my than first water been called who its now find long down day did get come made may part over new take only little work know place years live me back give most very after things our just name good think say great where help through much before line right too means same cannot account please update",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy años hasta desde está mi porque qué sólo han yo hay vez puede todos así nos ni parte tiene él uno donde bien tiempo mismo ese ahora cada vida otro después te otros aunque esa eso hace otra gobierno tan durante siempre día tanto ella tres sí dijo sido gran país según menos estoy cuenta puedo gracias señor niño mañana",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ont aux d'un cette d'une ou mais comme nous leur son sa deux été aussi être fait ans même entre je vous tout elle bien sans peut tous après ces si faire dont autres où encore contre avant lui depuis toujours année pays moins temps autre trois quand ainsi peu sous très cela j'ai c'est qu'il n'est mon votre notre était compte merci bonjour problème jour vie monde français",
    "id": "yang dan di itu dengan untuk tidak ini dari dalam akan pada juga saya ke karena tersebut bisa ada mereka lebih kata tahun sudah atau saat oleh menjadi orang ia telah adalah seperti sebagai bahwa dapat para harus namun kita dua satu masih hari hanya mengatakan kepada kami setelah melakukan lalu belum lain dia kalau terjadi banyak menurut anda hingga tak baru beberapa ketika saja jalan sekitar secara dilakukan sementara tapi sangat hal sehingga seorang bagi besar lagi selama antara waktu sebuah jika sampai jadi terhadap serta pun salah merupakan akun masuk terima kasih",
    "it": "di e il la che a per in un è non una sono si le del con da i dei al come più nel della anche ha gli alla ma lo delle ci mi se ho o suo questo dal io tutti perché loro dopo stato anni prima quando essere fatto tra sua due ancora molto solo così hanno dalla ai nella cosa era chi sul poi tutto quello c'è senza fare lei tempo oggi già qui bene ora dove cui sempre questa degli alle vita grazie altri ogni sarà proprio mio quel volta può stata siamo mondo nostro giorno casa parte dell'anno",
    "nl": "de van het een en in is dat op te zijn met voor niet aan er om ook als dan maar bij of uit nog naar heeft hij ik door worden wordt deze over was kan meer hun zich werd je al hebben had wel geen moet nu tot we ze zo wat dit veel mijn gaan jaar haar mensen onder twee waar tegen goed maken alleen toch wij zou tussen komt andere zelf eerste tijd u dag onze na omdat waren zal staat weer mag zonder alle mij niets gaat gewoon nieuwe inloggen vragen zeggen",
    "pl": "w i na z do się nie jest że o to jak a za od po co tym przez ale są dla ma był być tego może już jego tylko oraz czy które było który przed tak bardzo która jej lub jako przy nad bez ich także więcej pod lat kiedy gdy sobie ten tej jeszcze ja mnie nas więc roku można nawet wszystko teraz mi jednak był została mogę będzie są jeśli dlatego żeby proszę dzień konto dziękuję ostatniej moje się zalogować wszystkich człowiek czasu między każdy pracy swoje",
    "pt": "de a o que e do da em um para é com não uma os no se na por mais as dos como mas foi ao ele das tem à seu sua ou ser quando muito há nos já está eu também só pelo pela até isso ela entre era depois sem mesmo aos ter seus quem nas me esse eles estão você tinha foram essa num nem suas meu às minha têm numa pelos elas havia seja qual será nós tenho lhe deles essas esses fazer ainda dia não anos são então pode conta obrigado atualização consigo após",
    "sv": "och i att det som en på är av för med den till inte om ett han men var jag sig från så har de hade kan när man ska vi skulle eller nu efter år också hon mycket vid mot upp där blir alla vara bara under andra ut sin då mig här detta över finns få får går sedan utan vad mer än dem hur kommer bli någon varit skall ingen honom sina dessa mellan första några många två göra även samma något själv tack konto logga uppdateringen dag även människor tid",
    "tr": "bir ve bu da de için ile çok ne daha gibi olarak kadar var o ama en olan sonra ben değil ki diye ya her mi yok olduğu kendi büyük şey zaman iki göre nasıl biz hiç olduğunu yeni ise türkiye bütün onun ilk önce bana şimdi aynı sen gün böyle biri başka öyle şu ancak tarafından oldu söyledi insan üzerinde içinde çünkü bile artık yıl benim değildi etti olur bunu nedeniyle hesabıma giriş yapamıyorum lütfen teşekkür güncelleme son yapılan ediyorum arasında hem veya",
    "vi": "và của là có được cho không trong một với các những người này đã khi để từ đến ra như về thì tôi cũng ở phải nhiều lại vào năm sẽ làm đó nhưng hay bị mà rất còn trên sau ông anh nếu theo thể việc nói chỉ đi họ biết nước mình qua hơn đang cùng lên vì ngày gì bạn nhà sự tại bởi trước thời gian con em chúng ta tài khoản đăng nhập cập nhật vui lòng cảm ơn vấn đề thế nào đâu nên rồi mới đều thấy muốn",
}
LATIN = tuple(sorted(WORDS))
_LETTERS = " " + "".join(sorted({c for words in WORDS.values() for c in words if c.isalpha()}))
_OTHER = len(_LETTERS)
_SIZE = _OTHER + 1
#: How far the sum of log-likelihood ratios is trusted: neighbouring trigrams tell much of the same.
TEMPER = 0.35

_tables: list[np.ndarray] = []


def _code() -> np.ndarray:
    """Letter numbers by code point below 8192, where all of them lie; blanks and what is no letter are 0, other letters one number."""
    out = np.zeros(8192, np.int64)
    for i in range(8192):
        c = chr(i).lower()
        out[i] = _LETTERS.index(c) if len(c) == 1 and c in _LETTERS else _OTHER if unicodedata.category(chr(i))[0] == "L" else 0
    return out


def _letters(text: str, code: np.ndarray) -> np.ndarray:
    points = np.frombuffer(unicodedata.normalize("NFC", text).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.concatenate([[0], code[np.minimum(points, 8191)], [0]])


def _trigrams(letters: np.ndarray) -> np.ndarray:
    """Numbers of trigrams that hold a letter in the middle."""
    if len(letters) < 3:
        return np.zeros(0, np.int64)
    n = (letters[:-2] * _SIZE + letters[1:-1]) * _SIZE + letters[2:]
    return n[letters[1:-1] > 0]


def tables() -> tuple[np.ndarray, np.ndarray]:
    """Letter numbers, and log-likelihoods by trigram and language; made once in each worker."""
    if not _tables:
        code = _code()
        like = np.empty((_SIZE**3, len(LATIN)), np.float32)
        for k, language in enumerate(LATIN):
            tri, one = np.zeros(_SIZE**3), np.full(_SIZE, 0.02)
            for rank, word in enumerate(WORDS[language].split()):
                letters = _letters(word, code)
                weight = 1 / math.sqrt(rank + 4)
                np.add.at(tri, _trigrams(letters), weight)
                np.add.at(one, letters[1:], weight)
            one /= one.sum()
            two = tri.reshape(_SIZE * _SIZE, _SIZE)
            two = two.reshape(_SIZE, _SIZE, _SIZE).sum(0) + 0.6 * one  # by the letter before
            two /= two.sum(1, keepdims=True)
            cube = tri.reshape(_SIZE, _SIZE, _SIZE) + 0.8 * two[None]
            like[:, k] = np.log(cube / cube.sum(2, keepdims=True)).ravel()
        _tables.extend([code, like])
    return _tables[0], _tables[1]


@F.arrow_udf(StructType([StructField("language", StringType()), StructField("confidence", DoubleType())]))
def _decided(texts: pa.Array, chosen: pa.Array) -> pa.Array:
    """Language and confidence: the chosen script's, or of a Latin text (others are null here) the trigrams' with the script's share."""
    code, like = tables()
    names, shares = chosen.field("language").to_pylist(), chosen.field("share").to_pylist()
    valid = chosen.is_valid().to_pylist()
    names, sure = [n if ok else None for n, ok in zip(names, valid)], [s if ok else None for s, ok in zip(shares, valid)]
    i = -1
    for part in by_size(texts):
        for text in part.to_pylist():
            i += 1
            if names[i] is not None or sure[i] is None:
                continue
            numbers = _trigrams(_letters(text, code)) if text else np.zeros(0, np.int64)
            if not len(numbers):
                sure[i] = None
                continue
            score = TEMPER * like[numbers].sum(0, dtype=float)
            best = int(score.argmax())
            names[i] = LATIN[best]
            sure[i] *= float(1 / np.exp(score - score[best]).sum())
    return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(sure, pa.float64())], ["language", "confidence"])


#: What holds every code point of the other scripts and of kana, and no common mark or letter of the Latin one.
FOREIGN = r"[\u0370-\u1FFF\u2C00-\uFFFF\x{10000}-\x{10FFFF}]"


def script_counts(text: Column) -> dict[str, Column]:
    """Letters of each script, and of kana."""
    counted = {s: F.regexp_count(text, F.lit(rf"\p{{Is{s}}}")) for s in SCRIPTS if s != "Latin"}
    # runs, not letters, are found, as there are far fewer of them
    counted["Latin"] = F.length(text) - F.length(F.regexp_replace(text, r"\p{IsLatin}+", ""))
    return counted | {"Kana": F.regexp_count(text, F.lit(r"[\p{IsHiragana}\p{IsKatakana}]"))}


def character_backend(text: Column) -> Column:
    """Language and confidence, for :func:`sievewright.operators.language.detect`; null where no letter of a known script stands."""
    n = script_counts(text)
    others = [s for s in n if s != "Latin"]
    # a text is searched for each script only where it can hold another than Latin
    foreign = F.when(~text.rlike(FOREIGN), F.struct(*[F.lit(0).alias(s) for s in others])).otherwise(F.struct(*[n[s].alias(s) for s in others]))

    def rows(n: Column) -> Column:
        count = {"Latin": n["Latin"]} | {s: n["foreign"][s] for s in others}
        east = count["Han"] + count["Kana"]
        found = [F.struct(count[s].alias("n"), F.lit(-i).alias("order"), F.lit(code).alias("code")) for i, (s, code) in enumerate(SCRIPTS.items()) if s != "Han"]
        found.append(F.struct(east.alias("n"), F.lit(-len(SCRIPTS)).alias("order"), F.when(count["Kana"] >= KANA_SHARE * F.greatest(east, F.lit(1)), "ja").otherwise("zh").alias("code")))
        return F.array(*found)

    def choose(scripts: Column) -> Column:
        best, total = F.array_max(scripts), F.aggregate(scripts, F.lit(0), lambda a, x: a + x["n"])
        return F.when(total > 0, F.struct(best["code"].alias("language"), (best["n"] / total).alias("share")))

    counts = F.array(F.struct(n["Latin"].alias("Latin"), foreign.alias("foreign")))
    # bound to variables, and carried through the function: the text is counted once
    decided = F.transform(F.transform(counts, rows), choose)[0]
    one = F.transform(F.array(decided), lambda c: F.struct(F.when(c.isNotNull() & c["language"].isNull(), text).alias("text"), c.alias("chosen")))[0]
    p = _decided(one["text"], one["chosen"])
    return F.when(p["language"].isNotNull(), F.struct(p["language"].alias("language"), F.round(p["confidence"], 9).alias("confidence")))
