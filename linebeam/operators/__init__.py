"""DataFrame operators; each is ``DataFrame -> DataFrame`` with keyword options."""
