"""Where rows go and come from: addresses, the stored contract and the governed table."""
