"""Every operator run over the shared test tables, with SQL texts to compare against."""
