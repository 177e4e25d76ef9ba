"""Word lists and patterns of the Italian spam and quality features."""

from __future__ import annotations

# Results depend on these terms, patterns and their spelling exactly as they stand.
DELIVERY_BRANDS = ["sda", "bartolini", "brt", "dpd", "gls", "poste delivery", "fedex", "ups", "dhl", "poste italiane", "amazon", "mondial relay", "parcel"]
BANK = ["iban", "addebito", "pagamento non autorizzato", "transazione", "movimento", "verifica pagamento", "bonifico istantaneo", "conto corrente", "carta", "carta bloccata", "scadenza carta", "wallet", "saldo disponibile", "rimborso in sospeso"]
IDENTITY = ["verifica identita", "documento di identita", "conferma documento", "selfie", "riconoscimento", "identificazione", "kyc", "aggiornamento dati", "conferma dati", "dati mancanti", "profilo incompleto", "carta d'identità", "passaporto"]
PRESSURE = ["solo per oggi", "posti limitati", "pezzi limitati", "offerta esclusiva", "prezzo speciale", "fino al", "risparmia", "approfitta ora", "ultimo giorno", "non perdere", "offerta riservata", "accesso immediato"]
FORMAL = ["cordiali saluti", "distinti saluti", "resto a disposizione", "rimango a disposizione", "restiamo a disposizione", "in attesa di riscontro", "buon lavoro", "saluti", "gentile", "spettabile", "buongiorno", "buonasera", "salve", "torni a trovarci", "grazie", "grazie mille"]
ADMIN = ["in allegato", "allego", "alleghiamo", "si allega", "trasmettiamo", "fattura allegata", "fattura elettronica", "nota di credito", "proforma", "ddt", "documento di trasporto", "ordine cliente", "ordine fornitore", "conferma d ordine", "documentazione", "pratica"]
TECHNICAL = ["preventivo", "preventivo richiesto", "offerta commerciale", "scheda tecnica", "capitolato", "computo metrico", "sopralluogo", "appuntamento", "consegna materiale", "ritiro materiale", "fornitura", "posa", "cantiere", "materiale", "lavorazione", "montaggio", "misure", "progetto", "tavola", "disegno"]
BUSINESS_MORE = ["in riferimento a", "come concordato", "come da accordi", "come da richiesta", "ufficio", "fornitore", "cliente", "riunione"]
ACTION = ["clicca", "clicca qui", "verifica", "verifica ora", "conferma", "conferma ora", "accedi", "scarica", "attiva", "richiedi", "aggiorna", "scopri"]
MINI_STOPWORDS = "il lo la i gli le un uno una di a da in con su per tra fra e o ma che chi cui mi ti si ci vi sono sei è siamo siete ho hai ha abbiamo avete del della dello dei degli delle al allo alla ai agli alle dal dallo dalla dai dagli dalle nel nello nella nei negli nelle questo questa questi queste quello quella quelli quelle non più come dove quando anche".split()
COMMON_WORDS = "pagamento ordine consegna fattura cliente servizio offerta spedizione verifica accesso conto account documento messaggio richiesta conferma sicurezza codice clicca aggiorna attiva confermare ricevuto numero telefono indirizzo ufficio azienda supporto".split()
URGENCY = ["urgente", "subito", "immediato", "scade", "scadenza", "oggi", "entro oggi", "ultime ore", "adesso", "ora", "ultimo avviso", "bloccato", "sospeso"]
MONEY = ["gratis", "gratuito", "offerta", "sconto", "bonus", "premio", "vincita", "guadagno", "cashback", "rimborso", "pagamento", "bonifico", "saldo", "fattura", "euro", "€", "$", "£", "dollaro", "dollari", "pounds", "sterlina"]
CTA = ["clicca", "clicca qui", "clicca sul link", "premi qui", "accedi", "accedi ora", "verifica", "verifica ora", "verifica subito", "conferma", "conferma ora", "conferma subito", "aggiorna", "aggiorna ora", "scarica", "scarica ora", "attiva", "attiva ora", "richiedi", "richiedi ora", "completa", "completa ora", "procedi", "procedi ora", "continua", "continua qui", "visualizza", "visualizza qui", "consulta", "scopri", "scopri ora"]
ACCOUNT = ["account", "profilo", "accesso", "password", "credenziali", "verifica account", "reimposta password", "login", "conferma identità", "utenza", "conto", "conto corrente", "carta", "wallet", "profilo incompleto", "dati account"]
SECURITY = ["sicurezza", "alert", "allerta", "anomalo", "sospetto", "tentativo di accesso", "attività insolita", "blocco", "sospensione", "violazione", "accesso non autorizzato", "attivita sospetta", "verifica di sicurezza", "account compromesso", "anomalia", "blocco preventivo", "misura di sicurezza", "conferma identita", "protezione account"]
SAFE_SECURITY = ["non usare il link", "apri direttamente il portale", "sito ufficiale", "non ti chiederemo mai", "non chiediamo password", "non condividere credenziali", "non sono richiesti pagamenti", "non sono richieste conferme", "ignora questo messaggio", "se non è stato lei", "se non sei stato tu", "puoi ignorare", "nessuna azione richiesta", "accedi solo dal sito ufficiale", "verifica dal sito ufficiale", "non cliccare su link sospetti", "non comunicare password", "non comunicare il codice", "non fornire dati personali", "questa comunicazione non contiene link", "non ti verrà chiesto il pin", "non inserire credenziali", "contatta il supporto ufficiale"]
DELIVERY = ["consegna", "spedizione", "pacco", "corriere", "tracking", "tracciamento", "tentata consegna", "consegna fallita", "indirizzo errato", "indirizzo incompleto", "ritiro", "ritiro entro", "punto di ritiro", "giacenza", "fermo deposito", "spese di consegna", "spese doganali", "oneri doganali", "spedizione bloccata", "ordine in arrivo", "ordine sospeso", "tracking number"]
BRAND = ["poste italiane", "poste", "inps", "agenzia entrate", "paypal", "amazon", "dhl", "gls", "ups", "fedex", "banca", "intesa", "unicredit", "nexi", "visa", "mastercard", "apple", "google", "microsoft", "enel", "tim"]
UNSUBSCRIBE = ["unsubscribe", "disiscriviti", "cancella iscrizione", "annulla iscrizione", "rimuovi", "opt-out"]
PROMO_CODE = ["codice", "coupon", "promo", "promocode", "voucher", "gift card"]
PROMO_SYMBOLS = "%€$!£"
ACCENTED = "àèéìòù"
SUSPICIOUS_TLDS = [".xyz", ".top", ".click", ".live", ".shop", ".loan", ".buzz", ".win", ".cf", ".tk", ".ml", ".ga"]
SHORTENERS = ["bit.ly", "tinyurl.com", "t.co", "ow.ly", "cutt.ly", "rebrand.ly", "is.gd", "buff.ly"]
STOPWORDS = "il lo la i gli le un uno una l' un' di a da in con su per tra fra del della dello dei delle degli al alla allo ai agli alle all' dal dalla dallo dai dagli dall' nel nei nelle nello nella negli col coi sul sulla sui sulle sugli sullo sull' e o ma però tuttavia dunque quindi anche dove pure inoltre infatti invece mentre quando perché poiché benché affinché purché siccome ciò io tu egli lui lei esso noi voi loro essi mi ti ci vi si li ne me te ce ve se questo questa questi queste quello quella quelli quelle che cui chi c'è come quali quale quanto quanta quanti quante alcuni alcune qualche qualcosa qualcuno qualcuna nulla niente nessuno nessuna tutto tutte tutti tutta altro altri altre altra stesso stessa stessi stesse non sì no più meno molto poco troppo così allora già ancora sempre spesso mai qui qua là essere sono sei è siamo siete era erano sia siano avere ha hanno hai ho avete abbiamo po' com' c' d'".split()
URL_CHARS = r"[^\s<>()\[\]{}\"']"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
EMAIL_WITH_BAR = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
AMOUNT = r"€\s?\d+[\d.,]*|\d+[\d.,]*\s?€|\b\d+[\d.,]*\s?(?:euro|eur)\b"
PROMO_CODE_PATTERN = r"\b(?:codice(?:\s+(?:promo|sconto|offerta))?|coupon|promo(?:code)?|voucher)\b\s*[:=-]?\s*(?-i:[A-Z0-9][A-Z0-9_-]{3,})\b"
SIGNATURE = r"\bp\.?\s*iva\b|\bpartita\s+iva\b|\bcodice\s+fiscale\b|\bpec\b|\btel\.?\b|\btelefono\b|\bcell\.?\b|\bcellulare\b|\bsede\s+legale\b|\bsede\s+operativa\b|\bwww\.[^\s]+|\bvia\s+[a-zàèéìòù0-9\s,'-]+"
URL = rf"\bhttps?:/{{1,2}}{URL_CHARS}+|\bwww\.{URL_CHARS}+|\b(?:[a-z0-9](?:[a-z0-9-]{{0,61}}[a-z0-9])?\.)+[a-z]{{2,}}(?:/{URL_CHARS}*)?"
PLAIN_URL = r"https?://[^\s)>\]\"'}]*"
HTML_TAG = r"<[^>]+>"
MENU_WORDS = ["home", "contatti", "cookie policy", "privacy", "login"]
HAM_LABELS, SPAM_LABELS = ["ham", "not_spam", "non_spam", "legit"], ["spam", "junk"]
LABEL_KEYS = ["spam_label_gold", "spam_label", "spam_gold_label"]
# End of the fixed values.

BUSINESS = list(dict.fromkeys([*FORMAL, *ADMIN, *TECHNICAL, *BUSINESS_MORE]))
SPAM = list(dict.fromkeys([*URGENCY, *MONEY, *CTA, *ACCOUNT, *SECURITY, *DELIVERY, *BRAND, *DELIVERY_BRANDS, *BANK, *IDENTITY, *PRESSURE, *UNSUBSCRIBE, *PROMO_CODE, *ACTION]))
CATEGORIES = {"spam": SPAM, "urgency": URGENCY, "money": MONEY, "cta": CTA, "account": ACCOUNT, "security": SECURITY, "delivery": DELIVERY, "brand": BRAND, "unsubscribe": UNSUBSCRIBE, "promo": PROMO_CODE, "ham_business": BUSINESS, "ham_formal": FORMAL, "ham_admin_doc": ADMIN, "ham_technical_business": TECHNICAL, "action": ACTION, "safe_security": SAFE_SECURITY}
