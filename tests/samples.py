"""Generated export files and the small configuration the tests share."""

HEADER = (
    '"Data transakcji";"Data księgowania";"Dane kontrahenta";"Tytuł";"Nr rachunku";"Nazwa banku";'
    '"Szczegóły";"Nr transakcji";"Kwota transakcji (waluta rachunku)";"Waluta";'
    '"Kwota blokady/zwolnienie blokady";"Waluta";"Kwota płatności w walucie";"Waluta";"Konto";'
    '"Saldo po transakcji";"Waluta"'
)
FOOTER = '"Dokument ma charakter informacyjny";'

PATTERNS = {
    "own_name_investment_pattern": "%jan nowak%gdynia%",
    "own_name_rlike": "nowak.*jan|jan.*nowak",
    "investment_iban": "PL99000000000000000000",
    "employer_name": "%acme works%",
    "consulting_client": "%bright client%",
    "spouse_like": "%anna nowak%",
    "spouse_like_alt": "%ania nowak%",
    "family_member_rlike": "ewa nowak",
}

CATEGORIES = {
    "Food": ["Groceries", "Restaurant", "Food Misc"],
    "Home": ["Utilities"],
    "Transport": ["Fuel", "Taxi/Rideshare"],
    "Shopping": ["Furniture", "Media"],
    "Finance": ["Taxes"],
}

TRAINING = {
    "Groceries": ["biedronka", "lidl"],
    "Restaurant": ["mcdonald", "costa coffee"],
    "Fuel": ["orlen", "shell"],
    "Taxi/Rideshare": ["uber", "bolt"],
    "Furniture": ["ikea", "castorama"],
    "Media": ["amazon", "notino"],
    "Utilities": ["t-mobile"],
    "Taxes": ["urząd skarbowy"],
}


def row(date, party="", title="", details="TR.KART 1", txn="", amount="-10,00", account="", posted="", **more):
    blocked = more.get("blocked", "")
    return (
        f'{date};{posted};"{party}";"{title}";{account};"Bank";"{details}";{txn};{amount};PLN;{blocked};PLN;;;"Konto";100,00;PLN'
    )


def export(rows, count=None, header=HEADER, preamble='"Bank";', footer=FOOTER):
    declared = len(rows) if count is None else count
    lines = [preamble, f'"Liczba transakcji:";{declared};', "", header, *rows, footer]
    return "\n".join(line for line in lines if line is not None) + "\n"


JANUARY = [
    row("2025-01-02", "IKEA Kraków POL", "zakupy", posted="2025-01-03", txn="'123", amount="-1 234,56"),
    row("2025-01-03", "Acme Works Sp. z o.o.", "wynagrodzenie", "Przelew", "'124", "5 000,00"),
    row("2025-01-04", "Biedronka 123 Warszawa", "", txn="'125", amount="-45,10"),
    row("2025-01-05", "Kantor X", "", "Przelew kurs 4,2", "'126", "-400,00"),
    row("2025-01-06", "Jan Nowak", "own transfer", "Przelew", "'127", "-50,00"),
    row("2025-01-07", "Jan Nowak ul. Morska 1 Gdynia", "", "Przelew SEPA", "'128", "-900,00"),
    row("2025-01-08", "", "Orlen stacja 12", "BLIK 1", "'129", "-200,00"),
    row("2025-01-09", "Zupełnie nieznany", "cos", "TR.KART 2", "'130", "-7,77"),
]
FEBRUARY = [
    row("2024-02-10", "Bright Client GmbH", "faktura", "Przelew", "'201", "1 000,00"),
    row("2024-02-11", "Ewa Nowak", "vendita bici", "Przelew", "'202", "300,00"),
    row("2024-02-12", "Ewa Nowak", "", "Przelew", "'203", "-20,00"),
    row("2024-02-13", "Urząd Skarbowy", "PIT", "Przelew", "'204", "-120,00"),
    row("2024-02-14", "Uber", "", "", "'205", ""),
    row("2024-02-15", "Lidl; sklep", 'rata "0"'.replace('"', '""'), "TR.KART 9", "'206", "-33,00"),
    row("2024-02-16", "Bank", "Rata kredytu 5", "Przelew", "'207", "-1 500,00"),
    row("2024-02-17", "shell 0231", "", "Przelew", "'208", "-88,00"),
]
