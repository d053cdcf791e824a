"""Row operators (validate, clean, score), star-schema builders, DQ rules."""
