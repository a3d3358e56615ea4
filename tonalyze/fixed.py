"""Fixed values.

These equal the original application's values; results only match with
them.  They are stated here once, plainly, and imported everywhere else.
"""

# Class names of the model and the stored documents.
CLASS_POSITIVE = "positivo"
CLASS_NEGATIVE = "negativo"
CLASS_NEUTRAL = "neutral"
# Class shown when a stored prediction names none.
UNKNOWN_CLASS = "desconocido"

# Constant fields of stored documents and scoring responses.
STORED_STATE = "almacenado"
PROCESSED_STATUS = "processed"

# Wire record: text, three bars, label.
RECORD_DELIMITER = "|||"

# History sizes the callers ask for: API history, panel, overview.
HISTORY_LIMIT = 50
PANEL_LIMIT = 20
OVERVIEW_LIMIT = 10

# Characters shown in a text preview.
PREVIEW_CHARS = 50

# Display formats: ISO timestamps, es-ES date and time, probabilities.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
SPANISH_LOCALE_DATETIME = "d/M/yyyy, H:mm:ss"
PROBABILITY_DECIMALS = 3
MISSING_PROBABILITY = "N/A"
CSS_PREFIX = "sentiment-"

# Classifier parameters.
VOCAB_SIZE = 5000
MIN_DF = 1.0
SMOOTHING = 1.0
STOP_WORDS_LANGUAGE = "spanish"
