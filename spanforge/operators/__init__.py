"""DataFrame operators; each is ``DataFrame -> DataFrame`` or ``Column -> Column``."""
