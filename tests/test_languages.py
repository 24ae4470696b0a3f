"""The twenty languages of the character backend, in texts of our own, and its policy."""

import pytest

from sievewright.functions import languages as N
from sievewright.operators import language as L

TEXTS = {
    "ar": "توقفت الطابعة عن العمل أمس وأحتاج إلى مساعدة في كلمة المرور.",
    "de": "Seit gestern funktioniert der Drucker nicht mehr und ich brauche Hilfe beim Zurücksetzen.",
    "en": "My printer stopped responding yesterday and I need someone to reset the password.",
    "es": "La impresora dejó de funcionar ayer y necesito que alguien me ayude con la contraseña.",
    "fr": "L'imprimante ne fonctionne plus depuis hier et j'ai besoin d'aide pour le mot de passe.",
    "he": "המדפסת הפסיקה לעבוד אתמול ואני צריך עזרה עם הסיסמה.",
    "hi": "प्रिंटर ने कल से काम करना बंद कर दिया है और मुझे पासवर्ड में मदद चाहिए।",
    "id": "Printer saya berhenti bekerja sejak kemarin dan saya membutuhkan bantuan untuk kata sandi.",
    "it": "La stampante non funziona più da ieri e ho bisogno di aiuto con la mia password.",
    "ja": "昨日からプリンターが動かなくなり、パスワードの再設定を手伝ってほしいです。",
    "ko": "어제부터 프린터가 작동하지 않으며 비밀번호 재설정에 도움이 필요합니다.",
    "nl": "De printer werkt sinds gisteren niet meer en ik heb hulp nodig met mijn wachtwoord.",
    "pl": "Drukarka przestała działać wczoraj i potrzebuję pomocy z moim hasłem.",
    "pt": "A impressora deixou de funcionar ontem e preciso de ajuda com a minha senha.",
    "ru": "Вчера принтер перестал работать, и мне нужна помощь с паролем.",
    "sv": "Skrivaren slutade fungera igår och jag behöver hjälp med mitt lösenord.",
    "th": "เครื่องพิมพ์หยุดทำงานตั้งแต่เมื่อวานและฉันต้องการความช่วยเหลือเรื่องรหัสผ่าน",
    "tr": "Yazıcı dünden beri çalışmıyor ve şifremi sıfırlamak için yardıma ihtiyacım var.",
    "vi": "Máy in đã ngừng hoạt động từ hôm qua và tôi cần giúp đỡ về mật khẩu.",
    "zh": "打印机从昨天开始无法工作,我需要有人帮助我重置密码。",
}


@pytest.fixture(scope="module")
def detect(spark):
    def run(texts):
        t = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(2)
        found = {r.id: r for r in L.detect(t, "text", N.character_backend).collect()}
        return [found[i] for i in range(len(texts))]

    return run


def test_twenty_languages(detect):
    got = detect(list(TEXTS.values()))
    assert [r.language_detected for r in got] == list(TEXTS) and len(TEXTS) == 20
    assert all(r.status == "detected" and 0.8 <= r.confidence <= 1 for r in got)


def test_policy(detect):
    half = TEXTS["ru"] + " " + TEXTS["en"]
    got = detect([None, "", "OK", "1234 5678 !!", half, TEXTS["de"] * 500, "ααααα βββββ", "DRUCKER FUNKTIONIERT SEIT GESTERN NICHT", "漢字漢字漢字", "été derniere pour vous et nous dans le monde"])
    assert [r.status for r in got] == ["uncertain", "uncertain", "uncertain", "uncertain", "uncertain", "detected", "failed", "detected", "detected", "detected"]
    assert [r.language_detected for r in got][5:] == ["de", None, "de", "zh", "fr"]
    assert got[5].confidence == 1.0


def test_documents(spark):
    t = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null and text is not null")
    got = L.detect(t, "text", N.character_backend).where("status = 'detected'")
    n = got.count()
    assert n > 0.95 * t.count() and got.where("language_detected = lang").count() >= 0.99 * n


def test_texts_are_counted_once(spark):
    """Each script is searched for in one place of the plan, and letters of other scripts count among Latin ones."""
    frame = spark.createDataFrame([(1, "Привет, мир"), (2, "Это the мир"), (3, "日本語のテキスト"), (4, "12 ’ – 3"), (5, None), (6, "ǅ the und 한국어 한국어"), (7, "")], "id int, text string")
    got = L.detect(frame, "text", N.character_backend)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("IsHebrew") <= 2
    # Cyrillic by the share of its letters, six of nine
    assert [(r.id, r.language_detected, r.status) for r in got.orderBy("id").collect()[:5]] == [(1, "ru", "detected"), (2, None, "uncertain"), (3, "ja", "detected"), (4, None, "uncertain"), (5, None, "uncertain")]
