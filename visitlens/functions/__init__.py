"""Pure Column expressions: text cleaning, recoders and date parsers."""
