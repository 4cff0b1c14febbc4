"""fluxgrain.operators"""
